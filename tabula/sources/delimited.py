"""Delimited text: tolerant reading with declared columns, and typed or flat writing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tabula.functions.cleaning import null_if, parse_list_literal
from tabula.sources.records import records

_BROKEN = "_corrupt"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


_RULES = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}


def _read(spark: SparkSession, path: str, columns: Sequence[str], multiline: bool,
          header: bool) -> DataFrame:
    schema = StructType([*text_schema(columns), StructField(_BROKEN, StringType())])
    if multiline:
        parsed = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema), {**_RULES, "multiLine": "true"})
        # as a generator each record is parsed once and whole, whatever columns are asked for
        return records(spark, path, header).select(F.inline(F.array(parsed)))
    return spark.read.schema(schema).option("header", header).options(**_RULES).csv(path)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multiline: bool = True,
             na_tokens: Iterable[str] = (), header: bool = True) -> DataFrame:
    """Read all columns as text. Rows with too many fields are left out (see :func:`overlong_rows`);
    rows with too few keep NULLs at the end. Without ``columns`` the names are those of the header.

    Every file is read in splits by many tasks, also where cells hold line breaks
    (:mod:`tabula.sources.records`). ``multiline=False`` says that they hold none and saves the search for them.
    """
    columns = header_of(spark, path) if columns is None else columns
    rows = _read(spark, path, columns, multiline, header)
    # naming all columns keeps them in the scan: with fewer, Spark neither counts rows nor sees that one is too long
    named = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in columns])) >= 0
    good = rows.where(named & (F.col(_BROKEN).isNull() | ~_overlong(len(columns)))).drop(_BROKEN)
    tokens = list(na_tokens)
    return with_na(good, tokens) if tokens else good


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The cells of the first record of the first file; a header holds no line break."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start").where("file_block_start = 0")
    first = lines.where("value != ''").groupBy("file_path").agg(F.first("value").alias("line")).orderBy("file_path").first()
    if first is None:
        raise ValueError(f"no header below {path}")
    bare = re.sub('"[^"]*"', "", first["line"])
    slots = ", ".join(f"c{i} string" for i in range(bare.count(",") + 1))
    cells = spark.range(1).select(F.from_csv(F.lit(first["line"]), slots, {k: _RULES[k] for k in ("quote", "escape")}).alias("r")).first()["r"]
    return [c if c is not None else f"_c{i}" for i, c in enumerate(cells)]


def overlong_rows(spark: SparkSession, path: str, columns: Sequence[str],
                  multiline: bool = True, header: bool = True) -> DataFrame:
    """The rows :func:`read_csv` leaves out: first field and raw text."""
    rows = _read(spark, path, columns, multiline, header)
    return rows.where(F.col(_BROKEN).isNotNull() & _overlong(len(columns))).select(
        F.col(columns[0]), F.col(_BROKEN).alias("raw"))


def _overlong(width: int):
    """Fields of the raw record, counted outside quotes, exceed the declared width.

    A doubled quote ends one quoted piece and begins the next, so pieces need no alternation (which
    would take one stack frame for each character).
    """
    bare = F.regexp_replace(F.col(_BROKEN), '"[^"]*"', "")
    return F.size(F.split(bare, ",")) > width


def with_na(df: DataFrame, tokens: Iterable[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Cells equal to a missing-value token become NULL, in every text column or the named ones."""
    gone = list(tokens)
    names = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: null_if(F.col(f"`{n}`"), gone) for n in names})


def with_lists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Decode list-literal text columns to arrays."""
    return df.withColumns({c: parse_list_literal(F.col(f"`{c}`")) for c in columns})


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index column; arrays are written as list literals."""
    flat = df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, ArrayType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Typed columnar output, the form later jobs should read."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
