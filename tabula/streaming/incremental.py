"""Daily counts and first-seen rows over a stream of arriving files.

Both agree with their batch forms on the rows that are not later than the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_arrivals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files of a folder as a stream; zone-less times become timestamps, which event time needs."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumns({
        f.name: F.col(f.name).cast("timestamp") for f in schema.fields
        if f.dataType.typeName() == "timestamp_ntz"})


def daily_counts(rows: DataFrame, moment: str, late: str = "1 day") -> DataFrame:
    """(day, n) once a day is complete; quiet days are filled where the table is read."""
    days = rows.where(F.col(moment).isNotNull()).withWatermark(moment, late).groupBy(
        F.window(moment, "1 day"))
    return days.agg(F.count(F.lit(1)).alias("n")).select(
        F.to_date("window.start").alias("day"), "n")


def first_seen(rows: DataFrame, keys: Sequence[str], moment: str, late: str = "1 day") -> DataFrame:
    """The first arriving row of a key; copies within the watermark delay are dropped."""
    return rows.withWatermark(moment, late).dropDuplicatesWithinWatermark(list(keys))


def append_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, append it to a table, and stop."""
    return (rows.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
