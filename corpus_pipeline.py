"""Documents to token counts: language, near duplicates, repeated passages, benchmark leaks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import bpe_automaton, dart_minhash, decontaminate, language_codes, suffix_dedup
from tabula.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those that are ``und``, or whose two best codewords tie, go."""
    docs = docs.select(*COLUMNS)
    found = language_codes.predict(docs, language_codes.fit(docs), keep=COLUMNS)
    return found.where("lang_pred != 'und' and not ambiguous").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class; those without an id are in no class and stay."""
    return dart_minhash.first_of_each(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that an earlier document has in a string of 50."""
    found = suffix_dedup.remove_repeats(docs, ["doc_id", "lang", "source"])
    return found.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean_rows(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return bpe_automaton.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks), ("encoding", encoding)]

#: Signatures, learned codes and suffix order are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for turn, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if turn + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
