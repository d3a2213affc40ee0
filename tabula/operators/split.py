"""Reproducible stratified splits, folds and class weights.

Rows are ordered inside each label by the md5 of seed and id. The digest is uniform, so its leading
digits cut every label into even buckets: counts per bucket give exact positions and no task ever
sorts a whole label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.numeric import flag
from tabula.operators.sizing import attach, one_row, running_sums


def _keyed(df: DataFrame, id_column: str, seed: int, digits: int) -> DataFrame:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    return df.withColumn("_key", digest).withColumn("_bucket", F.substring("_key", 1, digits))


def _bucket_counts(keyed: DataFrame, label: str) -> DataFrame:
    cells = keyed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    along = running_sums(cells, [label], "_bucket", {"_n": "_upto"}, totals={"_n": "_rows"})
    return along.withColumn("_before", F.col("_upto") - F.col("_n"))


def stratified_split(df: DataFrame, id_column: str, label: str, fraction: float, seed: int = 42,
                     name: str = "is_test", digits: int = 4) -> DataFrame:
    """Mark exactly round(fraction * rows) rows of every label.

    Only rows of the one bucket where a label's quota falls are sorted; every other row compares its
    key with the label's last selected key.
    """
    keyed = _keyed(df.where(F.col(label).isNotNull()), id_column, seed, digits)
    cells = _bucket_counts(keyed, label).withColumn(
        "_quota", F.round(F.col("_rows") * fraction).cast("bigint"))
    edge_buckets = cells.where(
        (F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_upto"))
    ).select(label, "_bucket", (F.col("_quota") - F.col("_before")).alias("_need"))
    candidates = attach(keyed.select(label, "_bucket", "_key", id_column), edge_buckets,
                        [label, "_bucket"], how="inner")
    order = Window.partitionBy(label, "_bucket").orderBy("_key", id_column)
    edges = (candidates.withColumn("_rank", F.row_number().over(order))
             .where(F.col("_rank") == F.col("_need"))
             .select(label, F.struct("_key", id_column).alias("_edge")))
    marked = attach(keyed, edges, label)
    return marked.withColumn(
        name, flag(F.struct("_key", id_column) <= F.col("_edge"))).drop("_key", "_bucket", "_edge")


def stratified_folds(df: DataFrame, id_column: str, label: str, folds: int, seed: int = 42,
                     name: str = "fold", digits: int = 4) -> DataFrame:
    """Deal the rows of every label to the folds in turn, so fold sizes differ by at most one."""
    keyed = _keyed(df.where(F.col(label).isNotNull()), id_column, seed, digits)
    offsets = _bucket_counts(keyed, label).select(label, "_bucket", "_before")
    inside = Window.partitionBy(label, "_bucket").orderBy("_key", id_column)
    placed = attach(keyed, offsets, [label, "_bucket"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(inside))
    return placed.withColumn(name, ((F.col("_rank") - 1) % folds).cast("int")).drop(
        "_key", "_bucket", "_before", "_rank")


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = one_row(counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")))
    weights = counts.select(label, (whole["rows"] / (whole["classes"] * F.col("_n"))).alias(name))
    return attach(df, weights, label)


def negative_positive_ratio(label: Column, keep: Column | None = None) -> Column:
    """Aggregate: negatives per positive (at least one positive in the divisor)."""
    counted = F.lit(True) if keep is None else keep
    negatives = F.count_if(counted & (label == 0)).cast("double")
    return negatives / F.greatest(F.count_if(counted & (label == 1)), F.lit(1))


def positive_weights(df: DataFrame, label: str, excluded: Column, damping: float = 0.5,
                     name: str = "weight") -> DataFrame:
    """Positives outside the excluded rows weigh damping * negatives/positives, all others 1."""
    ratio = df.agg(negative_positive_ratio(F.col(label), ~excluded)).scalar()
    return df.withColumn(
        name, F.when(~excluded & (F.col(label) == 1), ratio * damping).otherwise(F.lit(1.0)))
