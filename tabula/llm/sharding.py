"""Shards by a keyed permutation of global row numbers, in DataFrame functions only.

Every row gets a number 0..n-1, a Feistel network over the grid ``a x b >= n`` permutes the numbers,
and a row at place p goes to shard ``p mod shards``, slot ``p div shards``. Nothing but n, the seed
and the number of shards decides where number x lands, so any row's shard and slot can be computed
without the others (:func:`place`), and shard counts differ by at most one (law ``rows``).

The grid is larger than n by less than a cells. A number that lands beyond n walks on along its
cycle. A walk visits each cell beyond n at most once, so ``a*b - n + 1`` steps always end it; only
the few rows that start beyond n (one in about sqrt(n)) evaluate the walk at all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.storage import stored

ROUNDS = 4


def _grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network: the halves are the row and column of x in the a x b grid."""
    state = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), F.lit(a)), F.lit(a)).cast("long")
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(left, i, F.lit(seed + 1)), F.lit(b)), F.lit(b)).cast("long")
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.reduce(rounds, state, turn, lambda s: s["l"] * F.lit(b) + s["r"])


def place(x: Column, n: int, seed: int) -> Column:
    """Permuted place of row number ``x`` among n rows."""
    a, b = _grid(n)
    first = _feistel(x, a, b, seed)
    walk = F.reduce(
        F.sequence(F.lit(1), F.lit(max(1, a * b - n + 1))), first,
        lambda y, _: F.when(y >= n, _feistel(y, a, b, seed)).otherwise(y))
    return F.when(first < n, first).otherwise(walk)


def numbered(keys: DataFrame, order: list[str], rows_per_bucket: int = 50_000) -> tuple[DataFrame, int]:
    """``row_no`` 0..n-1 on every row, without a sort in one task.

    Rows are dealt to buckets by a hash of all order columns, numbered inside their bucket and shifted
    by the counts of the buckets before; one row per bucket is all that one task ever orders.
    Identical rows are interchangeable: they travel as one row with a count and are spread again after.
    """
    n = keys.count()
    buckets = max(1, -(-n // rows_per_bucket))
    cells = (
        keys.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")))
    along = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    inside = cells.withColumn(
        "_before", F.sum("_copies").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_copies"))
    sizes = cells.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    offsets = sizes.select(
        "_bucket", (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_offset"))
    step = 65_536
    spread = (
        inside.join(offsets, "_bucket")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / step).cast("long"))))
        .withColumn("_in", F.explode(F.sequence(
            F.lit(0).cast("long"), F.least(F.lit(step - 1), F.col("_copies") - 1 - F.col("_chunk") * step).cast("long")))))
    return spread.select(
        *order, (F.col("_offset") + F.col("_before") + F.col("_chunk") * step + F.col("_in")).alias("row_no")), n


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20_231) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Reads ``doc_id`` and ``text`` only; other columns, whatever their names, are ignored. A null text
    counts as empty (size 1, crc 0); a null doc_id is a value like any other; identical rows get
    places of their own; an empty table gives no rows. ``grown_shard`` is null under law ``rows``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")), "shard-keys")
    rows, n = numbered(narrow, ["doc_id", "size", "text_crc32"])
    at = rows.withColumn("_place", place(F.col("row_no"), n, seed))
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
