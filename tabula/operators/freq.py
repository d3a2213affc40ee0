"""Counts, shares, crosstabs and scalar indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.cleaning import ordinal, strip
from tabula.functions.numeric import percent



def value_counts(df: DataFrame, column: str, keep_null: bool = False, name: str = "value") -> DataFrame:
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int, name: str = "value") -> DataFrame:
    """The k most frequent values; equal counts in value order."""
    return value_counts(df, column, name=name).orderBy(F.col("n").desc(), F.col(name)).limit(k)


def element_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """(value, n) over the trimmed non-blank elements of an array column.

    Elements are counted as they are and trimmed afterwards, once per distinct spelling.
    """
    spelled = df.select(F.explode(column).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    trimmed = spelled.select(strip(F.col(name)).alias(name), "_n").where(F.col(name) != "")
    return trimmed.groupBy(name).agg(F.sum("_n").alias("n"))


def top_elements(df: DataFrame, column: str, k: int, name: str = "value") -> DataFrame:
    """The k most frequent elements of an array column; equal counts in value order."""
    return element_counts(df, column, name).orderBy(F.col("n").desc(), name).limit(k)


def shares(counts: DataFrame, n: str = "n") -> DataFrame:
    """Add each row's percentage of the total of a count table."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.select("*", percent(F.col(n), total).alias("share"))


def share_by(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """(value, n, share) over the rows where the column is present."""
    return shares(value_counts(df, column, name=name))


def ordered_share(df: DataFrame, column: str, levels: Sequence[str], name: str = "value") -> DataFrame:
    """Shares of the ordered levels that occur, with their position."""
    counts = value_counts(df, column, name=name).select(
        "*", ordinal(F.col(name), levels).alias("level"))
    return shares(counts.where(F.col("level").isNotNull()))


def counts_with_flag(df: DataFrame, group: str, item: str, marked: Column) -> DataFrame:
    """(group, total, flagged, flagged_pct): non-NULL items and true flags per non-NULL group."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(item).alias("total"), F.count_if(marked).alias("flagged"),
             F.count(marked).alias("_known"))
        .select(group, "total", "flagged",
                percent(F.col("flagged"), F.col("_known")).alias("flagged_pct")))


def crosstab(df: DataFrame, row: str, column: str, levels: Sequence, prefix: str = "") -> DataFrame:
    """Count per row value and level (wide, zeros filled); rows NULL on either side are dropped."""
    both = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return both.groupBy(row).agg(*[
        F.count_if(F.col(column) == F.lit(level)).alias(f"{prefix}{level}") for level in levels])


def crosstab_percent(df: DataFrame, row: str, column: str, levels: Sequence, prefix: str = "") -> DataFrame:
    """Crosstab as a percentage of each row's total."""
    both = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return both.groupBy(row).agg(*[
        percent(F.count_if(F.col(column) == F.lit(level)), F.count(F.lit(1))).alias(f"{prefix}{level}")
        for level in levels])


def compare_levels(tables: Mapping[str, DataFrame], column: str, levels: Sequence[str]) -> DataFrame:
    """(level, position, one count column per table); absent levels show zero."""
    tagged = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("_table"), F.col(column).alias("_level"))
        for name, df in tables.items()])
    cells = {
        (name, i): F.count_if((F.col("_table") == name) & (F.col("_level") == level))
        for name in tables for i, level in enumerate(levels)}
    wide = tagged.agg(*[c.alias(f"{name}_{i}") for (name, i), c in cells.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(level).alias("level"), F.lit(i).alias("position"),
                 *[F.col(f"{name}_{i}").alias(name) for name in tables])
        for i, level in enumerate(levels)])))


def table_shares(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n, share) of all records."""
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()])
    return shares(counts)


def indicators(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """(indicator, value): any number of scalar aggregates in one pass."""
    row = df.agg(*[c.cast("double").alias(k) for k, c in named.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("indicator"), F.col(k).alias("value")) for k in named])))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return shares(value_counts(df, label, name=label))
