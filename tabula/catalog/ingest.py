"""Delimited text read in splits, its inferred schema, and dates whose layouts are found from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.catalog.registry import Tables, query
from tabula.operators import dates
from tabula.operators.sizing import shared_folder
from tabula.sources import delimited
from tabula.sources.inference import infer_schema, typed


def _quoted(column: str):
    text = F.concat(F.lit('"'), F.replace(F.col(column), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(text, F.lit(""))


def _documents_csv(t: Tables) -> str:
    """Documents as delimited text; their line feeds become line breaks inside quoted cells."""
    path = shared_folder(t.spark, "documents-csv")
    line = F.concat_ws(",", F.col("doc_id").cast("string"), _quoted("text"), _quoted("lang"), _quoted("source"))
    header = F.lit("doc_id,text,lang,source")
    t.documents.select(line.alias("value")).write.text(path)
    t.spark.range(1).select(header.alias("value")).write.mode("append").text(path)
    return path


@query("csv_parallel_scan", """
SELECT doc_id, md5(text) AS text_md5, length(text) - length(replace(text, chr(10), '')) AS line_feeds, lang, source FROM documents
""")
def csv_parallel_scan(t: Tables):
    """Whole texts with quoted line breaks, every file read in byte ranges."""
    rows = delimited.read_csv(t.spark, _documents_csv(t), ["doc_id", "text", "lang", "source"], header=False)
    feeds = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return rows.where("doc_id != 'doc_id'").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"),
        feeds.cast("bigint").alias("line_feeds"), "lang", "source")


@query("csv_row_count", "SELECT count(*) AS rows, count(text) AS texts FROM documents")
def csv_row_count(t: Tables):
    rows = delimited.read_csv(t.spark, _documents_csv(t), ["doc_id", "text", "lang", "source"], header=False)
    return rows.where("doc_id != 'doc_id'").agg(F.count(F.lit(1)).alias("rows"), F.count("text").alias("texts"))


def _orders_csv(t: Tables):
    """Orders as text with a header; one customer number is a word and two columns have empty cells."""
    path = shared_folder(t.spark, "orders-csv")
    key = F.col("o_orderkey")
    t.orders.select(
        key, F.when(key == 7, F.lit("n.n.")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"), "o_orderstatus",
        F.when(key % 3 != 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("o_totalprice"),
        F.when(key % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"), F.lit(None).cast("string").alias("remark"),
    ).write.option("header", True).csv(path)
    return delimited.read_csv(t.spark, path)


@query("infer_schema", """
SELECT 0 AS position, 'o_orderkey' AS "column", 'integer' AS type, count(*) AS cells, 0::BIGINT AS empty, count(*) AS integers,
  0::BIGINT AS decimals, 0::BIGINT AS timestamps, 0::BIGINT AS texts FROM orders
UNION ALL SELECT 1, 'o_custkey', CASE WHEN count_if(o_orderkey = 7) > 0 THEN 'text' ELSE 'integer' END, count(*), 0, count_if(o_orderkey <> 7), 0, 0,
  count_if(o_orderkey = 7) FROM orders
UNION ALL SELECT 2, 'o_orderstatus', 'text', count(*), 0, 0, 0, 0, count(*) FROM orders
UNION ALL SELECT 3, 'o_totalprice', 'decimal', count(*), count_if(o_orderkey % 3 = 0), 0, count_if(o_orderkey % 3 <> 0), 0, 0 FROM orders
UNION ALL SELECT 4, 'o_orderdate', 'timestamp', count(*), count_if(o_orderkey % 5 = 0), 0, 0, count_if(o_orderkey % 5 <> 0), 0 FROM orders
UNION ALL SELECT 5, 'remark', 'empty', count(*), count(*), 0, 0, 0, 0 FROM orders
""")
def infer_schema_of_orders(t: Tables):
    """Names from the header, types from one aggregate; one bad cell is counted."""
    return infer_schema(_orders_csv(t))


@query("csv_typed_scan", """
SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'n.n.' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
  CASE WHEN o_orderkey % 3 <> 0 THEN round(o_totalprice, 2) END AS o_totalprice, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS moment
FROM orders
""")
def csv_typed_scan(t: Tables):
    rows = typed(_orders_csv(t))
    return rows.select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"),
                       F.col("o_orderdate").cast("timestamp_ntz").alias("moment"))


def _dated(t: Tables):
    """Order dates written in eight ways; the ninth kind is no date."""
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 9
    ways = ["yyyy/MM/dd", "MMMM d, yyyy", "dd.MM.yyyy", "d MMM yyyy HH:mm", "M/d/yyyy", "d-MMM-yyyy", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy h:mm a"]
    text = F.lit("soon")
    for i, way in enumerate(ways):
        text = F.when(kind == i, F.date_format(d, way)).otherwise(text)
    return t.orders.select("o_orderkey", text.alias("when_raw"))


@query("dates_by_layout", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 < 8 THEN o_orderdate END AS moment FROM orders")
def dates_by_layout(t: Tables):
    rows = dates.with_dates(_dated(t), "when_raw", "moment")
    return rows.select("o_orderkey", F.col("moment").cast("timestamp_ntz").alias("moment"))


@query("date_shapes", """
SELECT CASE o_orderkey % 9 WHEN 0 THEN 'Y/9/9' WHEN 1 THEN 'a 9, Y' WHEN 2 THEN '9.9.Y' WHEN 3 THEN '9 a Y 9:9' WHEN 4 THEN '9/9/Y' WHEN 5 THEN '9-a-Y'
  WHEN 6 THEN 'Y-9-9 9:9:9' WHEN 7 THEN '9/9/Y 9:9 a' ELSE 'a' END AS shape, count(*) AS n, count_if(o_orderkey % 9 = 8) AS unread
FROM orders GROUP BY 1
""")
def date_shapes(t: Tables):
    return dates.unread_shapes(_dated(t), "when_raw")
