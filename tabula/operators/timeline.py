"""Zero-filled period counts and burst days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_counts(df: DataFrame, moment: str, unit: str) -> DataFrame:
    """(period, n) for every month or day from the first to the last; NULL times are dropped.

    Months carry their last day. The spine grows with the calendar span, not with the rows.
    """
    starts = (df.where(F.col(moment).isNotNull())
              .groupBy(F.trunc(moment, "month").alias("_start") if unit == "month"
                       else F.to_date(moment).alias("_start"))
              .agg(F.count(F.lit(1)).alias("_n")))
    step = F.expr(f"interval 1 {unit}")
    spine = starts.agg(F.min("_start").alias("a"), F.max("_start").alias("b")).select(
        F.explode(F.sequence("a", "b", step)).alias("_start"))
    label = F.last_day("_start") if unit == "month" else F.col("_start")
    return spine.join(starts, "_start", "left").select(
        label.alias("period"), F.coalesce("_n", F.lit(0)).alias("n"))


def monthly_counts(df: DataFrame, moment: str) -> DataFrame:
    return period_counts(df, moment, "month")


def daily_counts(df: DataFrame, moment: str) -> DataFrame:
    return period_counts(df, moment, "day")


def burst_days(df: DataFrame, moment: str, k: int = 5) -> DataFrame:
    """The k busiest days as text, earlier days first among equals."""
    days = daily_counts(df, moment).orderBy(F.col("n").desc(), "period").limit(k)
    return days.select(F.date_format("period", "yyyy-MM-dd").alias("day"), "n")
