"""Duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first along ``order``. NULL keys equal each other.

    Spark turns the filter on the row number into a group limit that runs before the shuffle as well
    as after it, so each task sends one row per key and copies of a hot key never travel.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).where(F.col("_place") == 1).drop("_place")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
