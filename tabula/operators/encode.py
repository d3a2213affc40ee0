"""Category encodings and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators.freq import top_values, value_counts
from tabula.operators.sizing import attach, one_row, running_sums


def label_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """(value, code): distinct values in order, coded from 0."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    numbered = running_sums(values.withColumn("_one", F.lit(1)), [], column, {"_one": "_code"})
    return numbered.select(column, (F.col("_code") - 1).cast("int").alias(name))


def label_encode(df: DataFrame, column: str, name: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Add the code of a category; a value the fitting rows lack gets NULL."""
    return attach(df, label_codes(df if fit_on is None else fit_on, column, name), column)


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per level; a NULL value is all zeros."""
    return df.select("*", *[
        F.coalesce((F.col(column) == F.lit(level)).cast("int"), F.lit(0)).alias(f"{prefix}_{level}")
        for level in levels])


@dataclass
class Levels:
    """Levels of a category as a table (level, code), where their names stay."""
    table: DataFrame
    size: int
    prefix: str

    def __len__(self) -> int:
        return self.size


def levels(df: DataFrame, column: str, prefix: str) -> Levels:
    """Coded levels, as many as there are by the largest code."""
    table = label_codes(df, column, "code").withColumnRenamed(column, "level")
    top = table.agg(F.max("code")).first()[0]
    return Levels(table, 0 if top is None else top + 1, prefix)


def one_hot_vector(df: DataFrame, column: str, name: str, prefix: str) -> tuple[DataFrame, Levels]:
    """One 0/1 slot per level in a sparse vector, for any number of levels; a NULL value is all zeros."""
    found = levels(df, column, prefix)
    codes = found.table.select(F.col("level").alias(column), F.col("code").alias("_code"))
    coded = attach(df, codes, column)
    if not found.size:
        return coded.withColumn(name, array_to_vector(F.array().cast("array<double>"))).drop("_code"), found
    # the slot kept for what is no level is the one that is dropped
    encoder = OneHotEncoder(inputCols=["_code"], outputCols=[name], handleInvalid="keep", dropLast=True).fit(codes)
    return encoder.transform(coded.fillna({"_code": found.size})).drop("_code"), found


def slot_names(spark: SparkSession, names: Sequence[str | Levels]) -> DataFrame:
    """(slot, name) of every slot of a vector assembled from columns and one-hot vectors in this order."""
    plain, tables, at = [], [], 0
    for one in names:
        if isinstance(one, Levels):
            tables.append(one.table.select(
                (F.col("code") + at).cast("long").alias("slot"), F.concat(F.lit(f"{one.prefix}_"), "level").alias("name")))
            at += one.size
        else:
            plain.append((at, one))
            at += 1
    named = spark.createDataFrame(plain, "slot long, name string")
    for table in tables:
        named = named.unionByName(table)
    return named


def levels_of(df: DataFrame, column: str, limit: int = 10_000) -> list[str]:
    """Sorted level names for a one-hot layout; refuses a column that is not a category."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels")
    return sorted(row[0] for row in found)


def top_or_other(df: DataFrame, column: str, k: int, name: str, other: str = "other") -> DataFrame:
    """Keep the k most frequent levels; the rest and NULL become ``other``."""
    top = top_values(df, column, k, name=column).select(column, F.lit(True).alias("_top"))
    # at most k rows
    return (df.join(F.broadcast(top), column, "left")
            .withColumn(name, F.when(F.col("_top"), F.col(column)).otherwise(F.lit(other)))
            .drop("_top"))


def drop_rare(df: DataFrame, column: str, least: int) -> DataFrame:
    """Only rows whose class has at least ``least`` rows."""
    classes = value_counts(df, column, name=column).where(F.col("n") >= least).select(column)
    return attach(df, classes, column, how="left_semi")


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled",
                fit_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population std (1 where the column is constant)."""
    moments = one_row((df if fit_on is None else fit_on).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]))
    return df.select("*", *[
        ((F.col(c) - moments[f"m{i}"])
         / F.when(moments[f"s{i}"] == 0, F.lit(1.0)).otherwise(moments[f"s{i}"])).alias(f"{c}{suffix}")
        for i, c in enumerate(columns)])
