"""Types of text columns, from what their cells look like.

Kinds form a lattice: empty < integer < decimal < text and empty < timestamp < text. A column's type is
the smallest kind that holds all its cells, so counts of kinds merge in any order and one aggregate
over all rows decides every column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.cleaning import null_if

# Cells of each kind, after trimming; a cell has the first kind that fits.
INTEGER = r"^[+-]?\d{1,18}$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
SPARK_TYPES = {"empty": "string", "integer": "bigint", "decimal": "double", "timestamp": "timestamp", "text": "string"}


def infer_schema(df: DataFrame, na_tokens: Iterable[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, type, cells, empty, integers, decimals, timestamps, texts) of the text columns.

    Missing and blank cells and the tokens are empty. The counts show how many cells decided: one bad cell
    makes a column text and stands in its ``texts``. A table without rows has only ``empty`` columns.
    """
    names = [c for c, kind in df.dtypes if kind == "string"] if columns is None else list(columns)
    tokens = list(na_tokens)
    places = {c: i for i, c in enumerate(df.columns)}

    def cell(name: str):
        text = F.trim(F.col(f"`{name}`"))
        text = null_if(text, tokens) if tokens else text
        kind = (F.when(text.isNull() | (text == ""), "empty").when(text.rlike(INTEGER), "integer")
                .when(text.rlike(DECIMAL), "decimal").when(text.rlike(TIMESTAMP), "timestamp").otherwise("text"))
        return F.struct(F.lit(places[name]).alias("position"), F.lit(name).alias("column"), kind.alias("kind"))

    if not names:
        return df.sparkSession.createDataFrame(
            [], "position int, column string, type string, cells long, empty long, integers long, decimals long, timestamps long, texts long")
    kinds = df.select(F.explode(F.array(*map(cell, names))).alias("c")).select("c.*")
    every = df.sparkSession.createDataFrame([(places[c], c) for c in names], "position int, column string")
    counts = kinds.groupBy("position", "column").agg(F.count(F.lit(1)).alias("cells"), *[
        F.count_if(F.col("kind") == kind).alias(name) for kind, name in
        (("empty", "empty"), ("integer", "integers"), ("decimal", "decimals"), ("timestamp", "timestamps"), ("text", "texts"))])
    whole = every.join(counts, ["position", "column"], "left").na.fill(0)
    numbers = F.col("integers") + F.col("decimals")
    decided = (
        F.when((F.col("texts") > 0) | ((numbers > 0) & (F.col("timestamps") > 0)), "text")
        .when(F.col("timestamps") > 0, "timestamp").when(F.col("decimals") > 0, "decimal")
        .when(F.col("integers") > 0, "integer").otherwise("empty"))
    return whole.select("position", "column", decided.alias("type"), "cells", "empty", "integers", "decimals", "timestamps", "texts")


def typed(df: DataFrame, na_tokens: Iterable[str] = ()) -> DataFrame:
    """The table with its text columns cast to their inferred types; one short row for each column is collected."""
    tokens = list(na_tokens)
    found = {r["column"]: r["type"] for r in infer_schema(df, tokens).collect()}

    def cast(name: str, kind: str):
        text = F.trim(F.col(f"`{name}`"))
        text = null_if(text, tokens) if tokens else text
        return F.nullif(text, F.lit("")).try_cast(SPARK_TYPES[kind])

    return df.withColumns({c: cast(c, k) for c, k in found.items() if k not in ("text", "empty")})
