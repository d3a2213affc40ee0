"""Exact quantiles, histograms, summaries and correlations without oversized groups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from tabula.operators.sizing import attach, one_row, running_sums, with_keys


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns; booleans are not numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def group_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, sample standard deviation and maximum per group."""
    return with_keys(df, keys).groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.max(value).alias("max"))


def quantiles(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles, one column ``q<i>`` per point.

    Values are counted first; the sorted running count over distinct values then locates the two
    neighbours of every point. The built-in exact percentile keeps all distinct values of a group in
    one buffer, which does not hold for continuous columns.
    """
    cells = (df.where(F.col(value).isNotNull())
             .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")))
    along = running_sums(cells, by, value, {"_n": "_upto"}, totals={"_n": "_total"})

    def spot(point: float) -> Column:
        return F.lit(float(point)) * (F.col("_total") - 1)

    reached = along.groupBy(*by).agg(
        *[F.min(F.when(F.col("_upto") > F.floor(spot(p)), F.col(value))).alias(f"_low{i}")
          for i, p in enumerate(points)],
        *[F.min(F.when(F.col("_upto") > F.ceil(spot(p)), F.col(value))).alias(f"_high{i}")
          for i, p in enumerate(points)],
        *[F.max(spot(p) - F.floor(spot(p))).alias(f"_part{i}") for i, p in enumerate(points)])
    return reached.select(*by, *[
        (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}"))
        .cast("double").alias(f"q{i}") for i in range(len(points))])


def median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return quantiles(df, value, [0.5], by).withColumnRenamed("q0", "median")


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max as one row."""
    quarters = one_row(quantiles(df, value, [0.25, 0.5, 0.75]))
    basics = df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    return basics.select("count", "mean", "std", "min", quarters["q0"].alias("p25"),
                         quarters["q1"].alias("p50"), quarters["q2"].alias("p75"), "max")


def _bin(value: Column, low: Column, width: Column, bins: int) -> Column:
    """Bin by comparing with the same edges that are reported; the last bin is closed."""
    guess = F.floor((value - low) / width)
    lowered = F.when(value < low + guess * width, guess - 1).otherwise(guess)
    raised = F.when(value >= low + (lowered + 1) * width, lowered + 1).otherwise(lowered)
    return F.least(F.greatest(raised, F.lit(0)), F.lit(bins - 1)).cast("int")


def _range(value: str, bins: int) -> list[Column]:
    """Lower edge and bin width; a single-valued column is widened by a half on both sides."""
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    same = low == high
    return [F.when(same, low - 0.5).otherwise(low).alias("_low"),
            (F.when(same, F.lit(1.0)).otherwise(high - low) / bins).alias("_width")]


def _edges(bins: int) -> list[Column]:
    return [(F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end")]


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]: (bin, bin_start, bin_end, n), empty bins included."""
    present = df.where(F.col(value).isNotNull())
    spread = present.agg(*_range(value, bins))
    limits = one_row(spread)
    counts = (present.groupBy(_bin(F.col(value), limits["_low"], limits["_width"], bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("_n")))
    spine = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    # both sides hold one row per bin
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin", *_edges(bins), F.coalesce("_n", F.lit(0)).alias("n"))


def histogram_by(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Histogram per group, each over its own range."""
    present = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(group, value)
    spread = present.groupBy(group).agg(*_range(value, bins))
    placed = attach(present, spread, group).select(
        group, _bin(F.col(value), F.col("_low"), F.col("_width"), bins).alias("bin"))
    counts = placed.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("_n"))
    spine = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, [group, "bin"], "left").select(
        group, "bin", *_edges(bins), F.coalesce("_n", F.lit(0)).alias("n"))


def _pair_correlation(a: str, b: str) -> Column:
    """Pairwise-complete Pearson correlation; a constant column gives NULL."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation) for every ordered pair, all moments in one pass.

    Fewer than three numeric columns give an empty table.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    pairs = list(combinations(range(len(names)), 2))
    moments = df.agg(
        *[_pair_correlation(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
        *[_pair_correlation(n, n).alias(f"c{i}_{i}") for i, n in enumerate(names)])
    cells = [(i, j, f"c{min(i, j)}_{max(i, j)}") for i in range(len(names)) for j in range(len(names))]
    table = moments.select(F.inline(F.array(*[
        F.struct(F.lit(names[i]).alias("column_a"), F.lit(names[j]).alias("column_b"),
                 F.col(key).alias("correlation")) for i, j, key in cells])))
    return table if len(names) >= 3 else table.where(F.lit(False))


def correlation_with(df: DataFrame, target: str, k: int = 20) -> DataFrame:
    """(feature, abs_correlation): the k numeric columns most correlated with the target."""
    names = [n for n in numeric_columns(df) if n != target]
    moments = df.agg(*[F.abs(_pair_correlation(n, target)).alias(f"c{i}") for i, n in enumerate(names)])
    table = moments.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("abs_correlation"))
        for i, n in enumerate(names)])))
    return table.orderBy(F.col("abs_correlation").desc_nulls_last(), "feature").limit(k)
