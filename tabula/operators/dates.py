"""Dates of a text column whose layouts are not known: shapes are counted, layouts chosen, then parsed once.

The shape of a cell keeps its separators and tells years (four digits), other numbers and words apart.
A shape decides a layout but for the order of day and month; that is settled by the numbers seen in the
column: a first number above 12 means day first, a second one above 12 month first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.cleaning import to_timestamp_any

# Shapes of dates with their layouts; where two are given, the first has the month first. Fixed values.
DATE_SHAPES = {
    "Y-9-9": ("y-M-d",), "Y/9/9": ("y/M/d",), "Y.9.9": ("y.M.d",), "9/9/Y": ("M/d/y", "d/M/y"), "9-9-Y": ("M-d-y", "d-M-y"),
    "9.9.Y": ("M.d.y", "d.M.y"), "a 9, Y": ("MMM d, y",), "a 9 Y": ("MMM d y",), "9 a Y": ("d MMM y",), "9-a-Y": ("d-MMM-y",)}
TIME_SHAPES = {"": "", " 9:9": " H:m", " 9:9:9": " H:m:s", " 9:9 a": " h:m a", " 9:9:9 a": " h:m:s a"}


def tidy(text: Column) -> Column:
    """Single spaces, names cut to three letters with a capital, a space for the T before a time."""
    spaced = F.trim(F.regexp_replace(F.regexp_replace(text, r"(\d)T(\d)", "$1 $2"), r"\s+", " "))
    short = F.regexp_replace(spaced, r"([A-Za-z]{3})[A-Za-z]*\.?", "$1")
    # initcap keeps the rest in small letters, and AM and PM are read in capitals
    return F.regexp_replace(F.initcap(short), r"\b([AaPp])[Mm]\b$", "$1M")


def shape_of(tidied: Column) -> Column:
    """The shape: Y a run of four digits, 9 any other run, a for a word."""
    words = F.regexp_replace(tidied, r"\p{L}+", "a")
    return F.regexp_replace(F.regexp_replace(words, r"(?<!\d)\d{4}(?!\d)", "Y"), r"\d+", "9")


def date_shapes(df: DataFrame, column: str) -> DataFrame:
    """(shape, n, first_over_12, second_over_12) of the cells that are not missing."""
    cells = df.where(F.col(f"`{column}`").isNotNull()).select(tidy(F.col(f"`{column}`")).alias("_t"))
    number = [F.regexp_extract("_t", r"^(\d{1,2})\D(\d{1,2})\D", i).try_cast("int") for i in (1, 2)]
    return cells.groupBy(shape_of(F.col("_t")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(number[0] > 12).alias("first_over_12"), F.count_if(number[1] > 12).alias("second_over_12"))


def layouts(df: DataFrame, column: str, day_first: bool = False) -> dict[str, str]:
    """The layout of each known shape that occurs; ``day_first`` settles shapes whose numbers don't.

    A shape with numbers above 12 in both places takes the order that reads more of its cells.
    """
    known = {d + t: tuple(x + TIME_SHAPES[t] for x in DATE_SHAPES[d]) for d in DATE_SHAPES for t in TIME_SHAPES}
    found = date_shapes(df, column).where(F.col("shape").isin(list(known))).collect()
    out = {}
    for r in found:
        ways = known[r["shape"]]
        swap = r["first_over_12"] > r["second_over_12"] if r["first_over_12"] != r["second_over_12"] else day_first
        out[r["shape"]] = ways[1 if swap and len(ways) > 1 else 0]
    return out


def with_dates(df: DataFrame, column: str, name: str, day_first: bool = False) -> DataFrame:
    """Add the moments of a text column; cells that no layout reads become NULL.

    Moments with a fraction or a zone are read as :func:`to_timestamp_any` does.
    """
    tidied = tidy(F.col(f"`{column}`"))
    shape, parsed = shape_of(F.col("_tidy")), []
    for s, layout in layouts(df, column, day_first).items():
        parsed.append(F.when(F.col("_shape") == s, F.try_to_timestamp(F.col("_tidy"), F.lit(layout))))
    moment = F.coalesce(*parsed, to_timestamp_any(F.trim(F.col(f"`{column}`"))))
    return df.withColumn("_tidy", tidied).withColumn("_shape", shape).withColumn(name, moment).drop("_tidy", "_shape")


def unread_shapes(df: DataFrame, column: str, day_first: bool = False) -> DataFrame:
    """(shape, n, unread): how many cells of each shape there are and how many stay without a date."""
    rows = with_dates(df.where(F.col(f"`{column}`").isNotNull()).select(column), column, "_moment", day_first)
    return rows.groupBy(shape_of(tidy(F.col(f"`{column}`"))).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_moment").isNull()).alias("unread"))
