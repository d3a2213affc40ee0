"""Table profiles: shape, column types, missing cells."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(pairs: list[tuple[str, Column]], name: str, value: str) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in pairs]))


def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column, nulls), one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    table = counts.select(_long([(c, F.col(f"`{c}`")) for c in df.columns], "column", "nulls"))
    return table.where(F.col("nulls") > 0) if only_missing else table


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df, only_missing=False).agg(F.sum("nulls").alias("nulls"))


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, rows, columns)."""
    def one(name: str, df: DataFrame) -> DataFrame:
        fields = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema.fields)])
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.inline(fields), "rows",
            F.lit(len(df.columns)).alias("columns"))
    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def missing_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, records, columns, missing_pct). Empty arrays are values, not missing cells."""
    def one(name: str, df: DataFrame) -> DataFrame:
        width = len(df.columns)
        missing = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns[1:]),
                      F.count_if(F.col(f"`{df.columns[0]}`").isNull()))
        return df.agg(F.count(F.lit(1)).alias("records"), missing.alias("m")).select(
            F.lit(name).alias("table"), "records", F.lit(width).alias("columns"),
            F.coalesce(F.try_divide(F.col("m") * 100.0, F.col("records") * width), F.lit(0.0))
            .alias("missing_pct"))
    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])
