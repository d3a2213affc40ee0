"""Group statistics brought back to rows: maxima, means, ranks, ratios, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.numeric import flag
from tabula.operators.sizing import attach, running_sums, with_keys


def with_group(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column],
               source: DataFrame | None = None) -> DataFrame:
    """Add group aggregates to every row; rows with a NULL key get NULL.

    ``source`` is the table to aggregate when ``df`` already carries other joins, so that they are
    not computed again below the aggregate.
    """
    return attach(df, group_stats(df if source is None else source, keys, stats), list(keys))


def group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """The aggregates of every group whose keys are all there."""
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])


def is_last(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Flag rows whose value is the group's maximum."""
    seen = with_group(df, keys, {"_top": F.max(value)})
    return seen.withColumn(name, flag(F.col(value) == F.col("_top"))).drop("_top")


def mean_std(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], prefix: str) -> DataFrame:
    """Group mean and sample std of several columns (column -> name part)."""
    stats = {}
    for column, part in values.items():
        stats[f"{prefix}_Avg_{part}"] = F.avg(column)
        stats[f"{prefix}_Std_{part}"] = F.stddev_samp(column)
    return with_group(df, keys, stats)


def remaining(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Group maximum minus value, and its ratio to the maximum."""
    seen = with_group(df, keys, {"_top": F.max(value)})
    left = F.col("_top") - F.col(value)
    return (seen.withColumn(name, left)
            .withColumn(f"{name}_Ratio", F.try_divide(left, F.col("_top"))).drop("_top"))


def percent_rank(df: DataFrame, group: str, value: str, name: str,
                 source: DataFrame | None = None) -> DataFrame:
    """Average rank inside the group over its non-NULL count, ties sharing their mean rank.

    Ranks come from running counts over distinct values, so a group of any size is only ever sorted
    after counting.
    """
    counted_rows = df if source is None else source
    cells = (counted_rows.where(F.col(group).isNotNull() & F.col(value).isNotNull())
             .groupBy(group, value).agg(F.count(F.lit(1)).alias("_n")))
    along = running_sums(cells, [group], value, {"_n": "_upto"}, totals={"_n": "_total"})
    ranks = along.select(
        group, value,
        ((F.col("_upto") - (F.col("_n") - 1) / 2) / F.col("_total")).alias(name))
    return attach(df, ranks, [group, value])


def ratio_and_zscore(df: DataFrame, group: str, value: str, ratio: str, zscore: str) -> DataFrame:
    """Value over the group maximum, and distance from the group mean in stds; divisors at least 1.

    A one-row group has no std and therefore no z-score.
    """
    seen = with_group(df, [group], {
        "_mean": F.avg(value), "_std": F.stddev_samp(value), "_top": F.max(value)})
    spread = F.when(F.col("_std").isNotNull(), F.greatest(F.col("_std"), F.lit(1.0)))
    return (seen.withColumn(ratio, F.col(value) / F.greatest(F.col("_top").cast("double"), F.lit(1.0)))
            .withColumn(zscore, (F.col(value) - F.col("_mean")) / spread)
            .drop("_mean", "_std", "_top"))


def above_group_mean(df: DataFrame, group: str, value: str, factor: float, name: str) -> DataFrame:
    """Flag rows above a multiple of their group's mean."""
    seen = with_group(df, [group], {"_mean": F.avg(value)})
    return seen.withColumn(name, flag(F.col(value) > F.col("_mean") * factor)).drop("_mean")
