"""Columnar tables, model metrics by task, prediction templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tabula.functions.numeric import flag


def read_table(spark: SparkSession, folder: str, name: str, parts: int | None = None) -> DataFrame:
    """One parquet table; zone-less times become session timestamps (UTC).

    ``parts`` deals the rows out evenly first, for heavy row expressions on a table that is a single small
    file. That is a shuffle of the whole table, so it only happens where the caller asks for it.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if parts:
        df = df.repartition(parts)
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
        if isinstance(f.dataType, TimestampNTZType)})


def metrics_of(metrics: DataFrame, task: str) -> DataFrame:
    """Metrics of one task. A table written with ``partition_by=["task"]`` is pruned to its folder;
    an unknown task gives no rows."""
    return metrics.where(F.col("task") == task)


def submission(template: DataFrame, predictions: DataFrame, id_column: str, score: str,
               threshold, name: str) -> DataFrame:
    """(id, class, probability) for every id of the template, matched by id, 1 above the threshold."""
    scored = template.select(id_column).join(predictions.select(id_column, score), id_column, "left")
    return scored.select(id_column, flag(F.col(score) > threshold).alias(name),
                         F.col(score).alias(f"{name}_prob"))
