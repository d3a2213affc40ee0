"""Building blocks for plans whose lookup or group size is only known at run time.

Nothing here assumes that a group fits one task. A lookup is broadcast only after its bytes were
measured; running totals leave the single-window form once the input has too many distinct values.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bytes of an aggregated lookup, measured in memory, that are still shipped to every executor.
BROADCAST_BYTES = 16 << 20
# Distinct cells that one sorted window task may walk through.
WINDOW_ROWS = 500_000
# Slices of a sliced running sum; past this, slices grow instead (their sort spills).
MAX_SLICES = 5_000


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    context.setCheckpointDir(folder)


def pinned(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder of the session, so that later reads see the same rows."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's checkpoint folder, for tables written between jobs."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Keep an aggregate for reuse and tell how many rows it has."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()


def measured_bytes(kept: DataFrame) -> int:
    """Bytes of a counted (so cached) table as Spark's own statistics give them."""
    plan = kept.select("*")._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present, as filters a columnar scan can use."""
    for key in keys:
        df = df.where(F.col(f"`{key}`").isNotNull())
    return df


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join a per-key aggregate back to the rows it came from.

    Replaces a window over raw rows: the aggregate is built with map-side partial sums, so a group
    holding a third of the table costs one row per task. Small lookups (by measured bytes) are broadcast and
    the rows never move. A larger lookup is written first: read back it has no partitioning of its
    own, so both sides are shuffled for the join, which is what lets adaptive execution split the
    partition of a hot (or missing) key over many tasks. A cached lookup would prevent that.
    """
    keys = [on] if isinstance(on, str) else list(on)
    kept, _ = counted(lookup)
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if measured_bytes(kept) <= limit:
        return rows.join(F.broadcast(kept), keys, how)
    large = stored(kept, "lookup")
    kept.unpersist()
    return rows.join(large, keys, how)


def attach_all(
    rows: DataFrame,
    source: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left joins of several per-key aggregates of ``source``, whose keys lie within the longest ones.

    Small lookups are broadcast as by :func:`attach`. Large ones are first joined to the key combinations that occur,
    so that the rows are shuffled once and not for each of them. A combination with a missing key has the values of
    those lookups whose own keys it has.
    """
    kept = [(counted(lookup)[0], list(keys)) for lookup, keys in lookups]
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    small = [(lookup, keys) for lookup, keys in kept if measured_bytes(lookup) <= limit]
    large = [(lookup, keys) for lookup, keys in kept if not any(lookup is s for s, _ in small)]
    order, added = rows.columns, [c for lookup, keys in kept for c in lookup.columns if c not in keys]
    if large:
        longest = max((keys for _, keys in large), key=len)
        found = source.select(*longest).distinct()
        for lookup, keys in large:
            found = found.join(lookup, keys, "left")
        own = [f"_at_{i}" for i in range(len(longest))]
        found = stored(found.withColumnsRenamed(dict(zip(longest, own))), "lookups")
        for lookup, _ in large:
            lookup.unpersist()
        same = reduce(lambda a, b: a & b, [F.col(f"`{key}`").eqNullSafe(F.col(at)) for key, at in zip(longest, own)])
        rows = rows.join(found, same, "left").drop(*own)
    for lookup, keys in small:
        rows = rows.join(F.broadcast(lookup), keys, "left")
    return rows.select(*[f"`{c}`" for c in [*order, *added]])


def running_sums(
    cells: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
    descending: bool = False,
    window_rows: int | None = None,
) -> DataFrame:
    """Add inclusive running sums along ``order`` inside ``by``, and whole sums per ``by``.

    ``sums`` and ``totals`` map a column to its new name. ``cells`` holds one row per distinct
    (by, order). Few cells: one window. Many cells: range partition them into slices, sum each slice
    inside its own task, and add the sums of the slices before it, of which there are few.
    """
    totals = dict(totals or {})
    limit = WINDOW_ROWS if window_rows is None else window_rows
    kept, size = counted(cells)
    along = F.col(order).desc() if descending else F.col(order).asc()
    keys = list(by)
    if size <= limit:
        window = Window.partitionBy(*keys).orderBy(along).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*keys)
        return kept.select(
            "*", *[F.sum(c).over(window).alias(new) for c, new in sums.items()],
            *[F.sum(c).over(whole).alias(new) for c, new in totals.items()])

    slices = min(MAX_SLICES, max(2, math.ceil(2 * size / limit)))
    ranged = pinned(
        kept.repartitionByRange(slices, *[F.col(k) for k in keys], along)
        .withColumn("_slice", F.spark_partition_id()))
    kept.unpersist()
    inside = Window.partitionBy("_slice", *keys).orderBy(along).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (
        ranged.groupBy("_slice", *keys)
        .agg(*[F.sum(c).alias(f"_sum_{new}") for c, new in sums.items()],
             *[F.sum(c).alias(f"_all_{new}") for c, new in totals.items()])
        .select("_slice", *keys, *[
            F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_off_{new}")
            for new in sums.values()],
            *[F.sum(f"_all_{new}").over(whole).alias(new) for new in totals.values()])
        .select(F.col("_slice").alias("_at"), *[F.col(k).alias(f"_at_{k}") for k in keys], *[
            f"_off_{new}" for new in sums.values()], *totals.values()))
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_in_{new}") for c, new in sums.items()])
    # a missing key is a group like any other, so the offsets are found null-safe
    same = F.col("_slice") == F.col("_at")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_at_{key}"))
    joined = local.join(offsets, same)
    return joined.select(
        *cells.columns,
        *[(F.col(f"_in_{new}") + F.col(f"_off_{new}")).alias(new) for new in sums.values()],
        *totals.values())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table once into the shared folder and read it back, columnar and typed.

    For tables that many jobs read (report pages, folds, fits): the plan above it stays small, and a
    lost executor costs re-reading a file instead of recomputing the table.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> Column:
    """The only row of an ungrouped aggregate as a struct-valued scalar subquery (no join)."""
    return df.select(F.struct(*df.columns)).scalar()
