"""Registered queries of the operators in this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import (
    bpe_automaton, dart_minhash, decontaminate, divergence, fill_in_middle, html_blocks, language_codes, license_scan, multi_index, sharding, suffix_dedup,
    token_counts, token_files)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        return build
    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_token_files")
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_table(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@_query("op2_html_blocks")
def op2_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_blocks.extract(pages, html_blocks.fit(pages))


@_query("op3_multi_index")
def op3_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@_query("op4_dart_minhash")
def op4_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return dart_minhash.near_duplicates(_table(spark, folder, "documents"))


@_query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, folder, "documents"), ["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op6_language_codes")
def op6_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = language_codes.predict(docs, language_codes.fit(docs))
    return found.select(
        "doc_id", (language_codes.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


@_query("op7_cgk_decontamination")
def op7_cgk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op8_feistel_shards")
def op8_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, folder, "documents"), shards=8)


@_query("op9_license_scan")
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.licenses(_table(spark, folder, "documents"))


@_query("op10_bpe_automaton")
def op10_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_automaton.encode_digests(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query("op11_prefix_counts")
def op11_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.prefix_table(
        _table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096, store=False)


@_query("op12_source_divergence")
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


ORACLE["op12_source_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT row_no, lang, source,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_tf FROM words GROUP BY ALL HAVING count(DISTINCT row_no) >= 10),
counts AS (SELECT lang, source, term, count(*) AS tf FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_tf) AS lang_n FROM kept GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(tf) AS n FROM counts GROUP BY ALL) c USING (lang, source)),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.tf, 0) AS tf,
           1 + (1000000000 * (coalesce(c.tf, 0)::HUGEINT + 2)) // (g.n + 2 * l.v) AS p,
           1 + (1000000000 * (k.lang_tf::HUGEINT + 2)) // (l.lang_n + 2 * l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT s.lang, s.source, t.source AS item, sum(((s.p - t.p) * (s.p - t.p)) // (s.p + t.p)) AS value
        FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
both_parts AS (
    SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE tf > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@_query("op13_fill_in_middle")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_in_middle.transform(_table(spark, folder, "documents"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


ORACLE["op13_fill_in_middle"] = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents),
drawn AS (
    SELECT *, len(u) AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(digest, 9, 8))::BIGINT % (len(u) + 1) AS b,
           CASE WHEN text = '' OR regexp_matches(text, '<P>|<S>|<M>') OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
                WHEN ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM units),
cut AS (
    SELECT doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') AS prefix,
           array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(u[greatest(a, b) + 1:], '') AS suffix
    FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
