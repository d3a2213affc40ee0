"""Connected components of a link table, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.storage import stored


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node that has a link.

    Each round is two group-by minima with partial sums and joins that adaptive execution may split, so
    a node with very many links is no one task's burden; rounds grow with the logarithm of the longest
    chain. Every round is a written table.
    """
    edges = stored(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u != v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        following = stored(small, "links")
        if following.exceptAll(edges).isEmpty() and edges.exceptAll(following).isEmpty():
            break
        edges = following
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
