"""How the word use of each source differs from its language and from every other source, in exact integers.

A group is one (lang, source). With V terms kept for a language and N occurrences of them in a group, a
term has the share p = 1 + floor(10^9 (count + 2) / (N + 2 V)), which is the same baseline z for every term
the group lacks, and two shares differ by f(p, q) = floor((p - q)^2 / (p + q)).

The sum of f over all kept terms, for every two groups g and h of a language, is split into

    sum over terms of both:  f(p, q) - f(p, z_h) - f(z_g, q) + f(z_g, z_h)
    + sum over terms of g:   f(p, z_h) - f(z_g, z_h)        + the same of h against g
    + V f(z_g, z_h)

The first sum is a sparse product by rows. A task holds a block of the index from terms to their
groups; each group in turn walks its terms through the index and adds into one dense array with
a place for every peer, so no pair of postings is ever a row. The others need only how many terms of a group
have each share. Everything is integer arithmetic; sums come out the same in any order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.storage import lean_memory, slices, small_batches, stored

#: Documents of a language that must hold a term.
LEAST_DOCS = 10
TERMS_SHOWN = 10
SCALE = 1_000_000_000
#: Term counts held in a task before they are handed on.
HELD = 300_000
#: Postings (term and group) in a block of the index, and pairs of them in one step of a walk.
BLOCK = 200_000
STEP = 1_000_000
#: Characters of a text that are searched for terms at once.
WINDOW = 1_000_000
_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text: str) -> Iterator[list[str]]:
    """The terms of a text, in lists of bounded length; A-Z become a-z."""
    at = 0
    while at < len(text):
        stop = at + WINDOW
        while stop < len(text) and _TERM.match(text[stop]):  # not within a term
            stop += 1
        yield _TERM.findall(text[at:stop].translate(_LOWER))
        at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, tf, df: occurrences and documents; one row with a null term for every group."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (often, where) in groups.items():
                n = len(often) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([None, *often], pa.string()),
                    pa.array([0, *often.values()], pa.int64()), pa.array([0, *map(where.__getitem__, often)], pa.int64())],
                    names=["lang", "source", "term", "tf", "df"])
            groups.clear()

        held = 0
        for batch in slices(batches, 2):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                often, where = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(often), set()
                for terms in terms_of(text):
                    often.update(terms)
                    own.update(terms)
                where.update(own)
                held += len(often) - before
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (
        rows.mapInArrow(count, "lang string, source string, term string, tf long, df long")
        .groupBy("lang", "source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count; null where the language keeps no term."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)"), F.nullif(
        total + 2 * terms, F.lit(0)).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _walk(begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    n = stop - begin
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


_PART = "lang string, g int, peers array<int>, sums array<long>"


def _part(lang: str, g: int, peers: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    one = pa.array([0, len(peers)], pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()), pa.array([g], pa.int32()),
        pa.ListArray.from_arrays(one, pa.array(peers, pa.int32())), pa.ListArray.from_arrays(one, pa.array(sums, pa.int64()))],
        names=["lang", "g", "peers", "sums"])


def _common(key: tuple, table: pa.Table) -> pa.Table:
    """The sum over common terms of one block of the index, for every group and the peers numbered above it."""
    lang = key[0].as_py()
    term, g, p, z = (table[c].to_numpy() for c in ("t", "g", "p", "z"))
    order = np.lexsort((g, term))
    term, g, p, z = term[order], g[order], p[order], z[order]
    ends = np.searchsorted(term, term, side="right")  # where the groups of a posting's term end
    baseline = np.zeros(int(g.max()) + 1, np.int64)
    baseline[g] = z
    out = []
    by_group = np.argsort(g, kind="stable")
    for own in np.split(by_group, np.flatnonzero(np.diff(g[by_group])) + 1):
        sums, met = np.zeros(len(baseline), np.int64), np.zeros(len(baseline), bool)
        after = ends[own] - own - 1
        cuts = np.searchsorted(np.cumsum(after), np.arange(STEP, after.sum() + 1, STEP)) + 1
        for some in np.split(own, np.unique(cuts)):
            peer = _walk(some + 1, ends[some])
            if len(peer):
                x, q, h, zero = np.repeat(p[some], ends[some] - some - 1), p[peer], g[peer], z[some[0]]
                np.add.at(sums, h, _distance(x, q) - _distance(x, baseline[h]) - _distance(zero, q) + _distance(zero, baseline[h]))
                met[h] = True
        peers = np.flatnonzero(met)
        if len(peers):
            out.append(_part(lang, int(g[own[0]]), peers, sums[peers]))
    schema = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("peers", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64()))])
    return pa.Table.from_batches(out, schema)


def _against_baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums over a group's own terms against the baseline of every peer, and the zero baselines themselves."""
    for batch in batches:
        for row in batch.to_pylist():
            z = np.asarray(row["baselines"], np.int64)
            own, g = z[row["g"]], row["g"]
            plain = _distance(own, z)
            sums = np.where(np.arange(len(z)) > g, plain * row["v"], 0)
            for p, n in zip(row["shares"] or (), row["many"] or ()):
                sums += n * (_distance(np.int64(p), z) - plain)
            peers = np.delete(np.arange(len(z)), g)
            yield _part(row["lang"], g, peers, sums[peers])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, terms_shown: int = TERMS_SHOWN) -> DataFrame:
    """lang, source, part, item, value, rank: every peer of each group, and the terms it uses most beyond its language.

    Reads ``lang``, ``source`` and ``text``; nulls count as empty strings, which are a language and a source like
    any other. Repeated rows are documents of their own. Ties in value go by item. A group without terms has
    a ``pair`` row for every peer (0 where its language keeps no term) and no ``term`` rows; an empty table
    gives no rows; other columns are ignored. Texts are read whole, in windows that end between terms.
    """
    spark = docs.sparkSession
    cells = stored(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = stored(
        cells.where("term is not null")
        .withColumn("lang_tf", F.sum("tf").over(of_term))
        .withColumn("lang_df", F.sum("df").over(of_term))
        .withColumn("first", F.row_number().over(of_term.orderBy("source")) == 1)
        .where(F.col("lang_df") >= least_docs).select("lang", "source", "term", "tf", "lang_tf", "first"), "kept-terms")
    languages = kept.groupBy("lang").agg(F.sum("tf").alias("lang_n"), F.count_if("first").alias("v"))
    numbered = Window.partitionBy("lang").orderBy("source")
    v, n = F.coalesce("v", F.lit(0)), F.coalesce("n", F.lit(0))
    groups = stored(
        cells.where("term is null").select("lang", "source")
        .join(kept.groupBy("lang", "source").agg(F.sum("tf").alias("n")), ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang", "source", (F.row_number().over(numbered) - 1).alias("g"), n.alias("n"), v.alias("v"),
            F.coalesce("lang_n", F.lit(0)).alias("lang_n"), F.coalesce(share(F.lit(0), n, v), F.lit(1)).alias("z")), "groups")
    postings = stored(
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "g", "z", share(F.col("tf"), F.col("n"), F.col("v")).alias("p"),
                share(F.col("lang_tf"), F.col("lang_n"), F.col("v")).alias("q")), "postings")

    blocks = max(1, -(-postings.count() // BLOCK))
    code = F.xxhash64("term")
    # Terms of one hash would be taken for one another, so the hash only picks the block and terms are numbered by rank in it.
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    common = (
        postings.select("lang", F.pmod(code, F.lit(blocks)).cast("int").alias("block"), "term", "g", "p", "z")
        .withColumn("t", F.dense_rank().over(in_block)).select("lang", "block", "t", "g", "p", "z")
        .groupBy("lang", "block").applyInArrow(_common, _PART))
    histogram = (
        postings.groupBy("lang", "g", "p").count().groupBy("lang", "g")
        .agg(F.collect_list(F.struct("p", "count")).alias("h"))
        .select("lang", "g", F.col("h.p").alias("shares"), F.col("h.count").alias("many")))
    baselines = groups.groupBy("lang").agg(
        F.expr("transform(array_sort(collect_list(struct(g, z))), x -> x.z)").alias("baselines"))
    alone = (
        groups.join(baselines, "lang").join(histogram, ["lang", "g"], "left")
        .select("lang", "g", "v", "baselines", "shares", "many").mapInArrow(_against_baselines, _PART))
    names = groups.select("lang", "g", "source")
    sums = (
        common.unionByName(alone)
        .select("lang", "g", F.explode(F.arrays_zip("peers", "sums")).alias("x"))
        .groupBy("lang", F.least("g", "x.peers").alias("a"), F.greatest("g", "x.peers").alias("b"))
        .agg(F.sum("x.sums").alias("value"))
        .join(names.withColumnsRenamed({"g": "a", "source": "one"}), ["lang", "a"])
        .join(names.withColumnsRenamed({"g": "b", "source": "other"}), ["lang", "b"]))
    pair = sums.select("lang", "value", F.explode(F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("x")).select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = postings.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return (
        pair.withColumn("rank", F.row_number().over(by_value))
        .unionByName(term.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= terms_shown)))
