"""Numeric expressions: flags, bins, ratios, elapsed days, row means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def flag(condition: Column) -> Column:
    """0/1; a comparison with NULL is 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days, rounded down (a negative two hours is -1)."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.floor(micros / F.lit(DAY_MICROS)).cast("int")


def cut(value: Column, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """Bin number for right-closed intervals (edge, next edge]; outside gives NULL."""
    first_low = value >= edges[0] if include_lowest else value > edges[0]
    binned = F.when(first_low & (value <= edges[1]), 0)
    for number, (low, high) in enumerate(zip(edges[1:], edges[2:]), start=1):
        binned = binned.when((value > low) & (value <= high), number)
    return binned


def row_mean(*values: Column) -> Column:
    """Mean of the non-NULL values of one row."""
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    present = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return F.try_divide(total, present)


def full_match(text: Column, pattern: str) -> Column:
    return flag(text.rlike(f"^(?:{pattern})$"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)
