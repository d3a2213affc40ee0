"""Sources, cleaning expressions, filters, duplicates and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.catalog.registry import Tables, query, r6
from tabula.functions import cleaning as c
from tabula.functions import numeric as num
from tabula.operators import dedup, encode, profile
from tabula.operators.sizing import shared_folder
from tabula.plans.cleaning import clean_all
from tabula.sources import delimited, tables

# ---- sources and sinks

_CSV_COLUMNS = ["event_id", "event_type", "value", "props", "note"]


@query("csv_robust_scan", """
SELECT event_id, event_type, value,
  CASE WHEN event_id % 77 <> 0 THEN props END AS props,
  CASE WHEN event_id % 77 <> 0 THEN 'first' || chr(10) || 'second "quoted", end' END AS note
FROM events WHERE event_id % 50 <> 0
""")
def csv_robust_scan(t: Tables):
    """Events written as raw text with over-long, short and multi-line rows, then read back."""
    def quoted(text):
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    start = F.concat_ws(",", F.col("event_id").cast("string"), "event_type", F.col("value").cast("string"))
    full = F.concat_ws(",", start, quoted(F.col("props")), quoted(F.lit('first\nsecond "quoted", end')))
    line = (F.when(F.col("event_id") % 50 == 0, F.concat(full, F.lit(",extra,fields")))
            .when(F.col("event_id") % 77 == 0, start).otherwise(full))
    path = shared_folder(t.spark, "robust-scan")
    t.events.select(line.alias("value")).write.text(path)
    rows = delimited.read_csv(t.spark, path, _CSV_COLUMNS, header=False)
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type",
                       c.to_number(F.col("value")).alias("value"), "props", "note")


@query("na_tokens", """
SELECT seq,
  CASE WHEN trim(etype_raw) NOT IN ('', 'N/A', 'null', 'NaN') THEN trim(etype_raw) END AS plain,
  CASE WHEN trim(etype_raw) NOT IN ('', 'N/A', 'null', 'NaN', 'NA') THEN trim(etype_raw) END AS compatible
FROM dirty_events
""")
def na_tokens(t: Tables):
    text = c.strip(F.col("etype_raw"))
    rows = t.derived("dirty_events").select("seq", text.alias("plain"), text.alias("compatible"))
    plain = delimited.with_na(rows, c.NA_TOKENS, ["plain"])
    return delimited.with_na(plain, c.NA_TOKENS_COMPAT, ["compatible"])


@query("list_literal_decode", """
SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 0 END AS size,
  CASE p_partkey % 6 WHEN 0 THEN replace(p_name, ' ', '|') WHEN 1 THEN p_brand || '|' || p_type
    WHEN 2 THEN p_brand || '|it''s' ELSE '' END AS items
FROM part
""")
def list_literal_decode(t: Tables):
    """Arrays rendered as list text in several ways: quoted literal, plain commas, mixed quotes, empty."""
    kind = F.col("p_partkey") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']")))
        .when(kind == 1, F.concat("p_brand", F.lit(" , "), "p_type", F.lit(", ")))
        .when(kind == 2, F.concat(F.lit("['"), "p_brand", F.lit("', \"it's\"]")))
        .when(kind == 3, F.lit("[]")).when(kind == 4, F.lit("")))
    decoded = delimited.with_lists(t.part.select("p_partkey", text.alias("items")), ["items"])
    return decoded.select("p_partkey", F.size("items").alias("size"),
                          F.array_join("items", "|").alias("items"))


@query("csv_roundtrip", """
SELECT p_partkey, p_name, p_retailprice, replace(p_name, ' ', '|') AS words FROM part
""")
def csv_roundtrip(t: Tables):
    table = t.part.select("p_partkey", "p_name", "p_retailprice", F.split("p_name", " ").alias("words"))
    path = shared_folder(t.spark, "roundtrip")
    delimited.write_csv(table, path)
    back = delimited.with_lists(
        delimited.read_csv(t.spark, path, table.columns, multiline=False), ["words"])
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name",
                       c.to_number(F.col("p_retailprice")).alias("p_retailprice"),
                       F.array_join("words", "|").alias("words"))


@query("metrics_by_task", """
SELECT 'model ' || l_linenumber AS model,
  round(avg(CASE WHEN (l_returnflag = 'R') = (l_discount > 0.05) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  l_linestatus AS task
FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL
""")
def metrics_by_task(t: Tables):
    """A metrics table stored by task, then one task read back through partition pruning."""
    hit = (F.col("l_returnflag") == "R") == (F.col("l_discount") > 0.05)
    metrics = t.lineitem.groupBy(
        F.concat(F.lit("model "), F.col("l_linenumber").cast("string")).alias("model"),
        F.col("l_linestatus").alias("task")).agg(r6(F.avg(hit.cast("int"))).alias("accuracy"))
    path = shared_folder(t.spark, "metrics")
    delimited.write_table(metrics, path, ["task"])
    return tables.metrics_of(t.spark.read.parquet(path), "F")


@query("submission_table", """
SELECT o_orderkey, CASE WHEN p.s > 0.42 THEN 1 ELSE 0 END AS target, round(p.s, 6) AS target_prob
FROM orders LEFT JOIN (
  SELECT l_orderkey, avg(l_discount * 10) AS s FROM lineitem GROUP BY 1) p ON p.l_orderkey = o_orderkey
""")
def submission_table(t: Tables):
    predictions = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.avg(F.col("l_discount") * 10).alias("s"))
    out = tables.submission(t.orders, predictions, "o_orderkey", "s", 0.42, "target")
    return out.withColumn("target_prob", r6("target_prob"))


# ---- cleaning expressions

@query("replace_unknowns", """
SELECT seq,
  CASE WHEN trim(etype_raw) NOT IN ('Unknown', 'unknown', 'UNKNOWN', '') THEN trim(etype_raw) END AS etype,
  CASE WHEN trim(tags_raw) NOT IN ('Unknown', 'unknown', 'UNKNOWN', '') THEN trim(tags_raw) END AS tags
FROM dirty_events
""")
def replace_unknowns(t: Tables):
    cleaned = clean_all(t.derived("dirty_events"))
    return cleaned.select("seq", F.col("etype_raw").alias("etype"), F.col("tags_raw").alias("tags"))


@query("safe_dates", """
SELECT seq, coalesce(try_strptime(when_raw, '%Y-%m-%d %H:%M:%S'), try_strptime(when_raw, '%m/%d/%Y')) AS moment
FROM dirty_events
""")
def safe_dates(t: Tables):
    return t.derived("dirty_events").select(
        "seq", c.to_timestamp_any(F.col("when_raw")).cast("timestamp_ntz").alias("moment"))


@query("safe_numeric", "SELECT seq, TRY_CAST(value_raw AS DOUBLE) AS value FROM dirty_events")
def safe_numeric(t: Tables):
    return t.derived("dirty_events").select("seq", c.to_number(F.col("value_raw")).alias("value"))


@query("regex_extract_int", """
SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS brand_number,
  CASE WHEN p_type LIKE '%1' THEN 1 END AS nothing FROM part
""")
def regex_extract_int(t: Tables):
    return t.part.select("p_partkey", c.extract_whole(F.col("p_brand"), r"Brand#(\d+)").alias("brand_number"),
                         c.extract_whole(F.col("p_type"), r"(\d+)").alias("nothing"))


@query("map_to_bool", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 0 END AS both_ways,
  CASE WHEN l_returnflag = 'A' THEN 1 END AS one_way
FROM lineitem
""")
def map_to_bool(t: Tables):
    mark = F.col("l_returnflag")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        c.map_values(mark, {"A": True, "R": False}).cast("int").alias("both_ways"),
        c.map_values(mark, {"A": True}).cast("int").alias("one_way"))


@query("split_multivalue", """
WITH parts AS (SELECT seq, coalesce(
  [trim(x) for x in string_split(tags_raw, ',')
   if trim(x) NOT IN ('Unknown', 'unknown', 'UNKNOWN', '')], []) AS items FROM dirty_events)
SELECT seq, CAST(len(items) AS INTEGER) AS size, array_to_string(items, '|') AS items FROM parts
""")
def split_multivalue(t: Tables):
    items = c.split_list(F.col("tags_raw"))
    return t.derived("dirty_events").select(
        "seq", F.size(items).alias("size"), F.array_join(items, "|").alias("items"))


@query("split_quoted_list", """
SELECT seq, CASE WHEN cwes = '' THEN 0 ELSE 2 END AS size,
  replace(trim(cwes, '"'), ', ', '|') AS items
FROM vulnerabilities_raw
""")
def split_quoted_list(t: Tables):
    items = c.split_quoted_list(F.col("cwes"))
    return t.derived("vulnerabilities_raw").select(
        "seq", F.size(items).alias("size"), F.array_join(items, "|").alias("items"))


@query("epoch_to_ts", """
SELECT event_id AS seq, CASE WHEN event_id % 8 = 0 THEN date_trunc('millisecond', ts) ELSE ts END AS moment
FROM events
""")
def epoch_to_ts(t: Tables):
    return t.derived("dirty_events").select(
        "seq", c.epoch_to_timestamp(F.col("epoch_raw")).cast("timestamp_ntz").alias("moment"))


@query("fill_defaults", """
SELECT seq, coalesce(tags_raw, 'missing') AS tags, coalesce(TRY_CAST(value_raw AS DOUBLE), 0) AS value,
  CASE WHEN flag_raw = 'Yes' THEN 1 ELSE 0 END AS flag
FROM dirty_events
""")
def fill_defaults(t: Tables):
    typed = t.derived("dirty_events").select(
        "seq", F.col("tags_raw").alias("tags"), c.to_number(F.col("value_raw")).alias("value"),
        c.map_values(F.col("flag_raw"), {"Yes": True, "No": False}).alias("flag"))
    filled = typed.fillna({"tags": "missing", "value": 0.0, "flag": False})
    return filled.withColumn("flag", F.col("flag").cast("int"))


@query("ordinal_map", """
SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 0 WHEN '3' THEN 1 WHEN '2' THEN 2 WHEN '1' THEN 3 END AS level
FROM orders
""")
def ordinal_map(t: Tables):
    return t.orders.select("o_orderkey", c.ordinal(
        F.col("o_orderpriority"), ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]).alias("level"))


@query("concat_text", """
SELECT seq, coalesce(tags_raw, '') || ' ' || coalesce(etype_raw, '') AS combined FROM dirty_events
""")
def concat_text(t: Tables):
    return t.derived("dirty_events").select(
        "seq", c.concat_text(F.col("tags_raw"), F.col("etype_raw")).alias("combined"))


@query("array_join_text", """
SELECT p_partkey, p_name || ' ' || p_type AS keywords FROM part
""")
def array_join_text(t: Tables):
    return t.part.select("p_partkey", c.join_arrays(
        F.split("p_name", " "), F.array("p_type")).alias("keywords"))


@query("first_or_default", """
SELECT seq, CASE WHEN seq % 6 = 0 THEN 'a' WHEN seq % 6 = 1 THEN event_type ELSE 'Unknown' END AS main
FROM dirty_events JOIN events ON event_id = seq
""")
def first_or_default(t: Tables):
    return t.derived("dirty_events").select(
        "seq", c.first_or(c.split_list(F.col("tags_raw")), "Unknown").alias("main"))


@query("days_between", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(floor((epoch_us(l_shipdate) - 36000000000 - epoch_us(o_orderdate)) / 86400000000.0) AS INTEGER) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def days_between(t: Tables):
    """Ship minus order time, ten hours earlier so that parts of days matter."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", num.whole_days(
        F.col("o_orderdate"), F.col("l_shipdate") - F.expr("interval 10 hours")).alias("days"))


# ---- filters

@query("filter_blank", """
SELECT doc_id FROM documents WHERE length(trim(CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE text END)) > 0
""")
def filter_blank(t: Tables):
    text = F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.col("text"))
    return t.documents.where(c.strip(text) != "").select("doc_id")


@query("scatter_positive", """
SELECT c_custkey, c_acctbal, CAST(n AS BIGINT) AS n, count(*) OVER () AS points FROM customer
JOIN (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n FROM orders GROUP BY 1)
  ON o_custkey = c_custkey
WHERE c_acctbal > 0 AND n > 0
""")
def scatter_positive(t: Tables):
    finished = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n"))
    points = t.customer.select("c_custkey", "c_acctbal").join(finished, "c_custkey").where(
        (F.col("c_acctbal") > 0) & (F.col("n") > 0))
    return points.withColumn("points", points.agg(F.count(F.lit(1))).scalar())


@query("high_severity_listing", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def high_severity_listing(t: Tables):
    return t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("rare_class_filter", """
SELECT doc_id, lang || '/' || source AS class FROM documents
WHERE lang || '/' || source IN (
  SELECT lang || '/' || source FROM documents GROUP BY 1 HAVING count(*) >= 10)
""")
def rare_class_filter(t: Tables):
    classes = t.documents.select("doc_id", F.concat_ws("/", "lang", "source").alias("class"))
    return encode.drop_rare(classes, "class", 10)


# ---- duplicates and profiles

@query("dedup_keep_first", """
SELECT doc_id, lang, source, n_chars, md5(text) AS digest FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def dedup_keep_first(t: Tables):
    first = dedup.keep_first(t.documents, ["text"], ["doc_id"])
    return first.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query("dedup_keep_first_composite", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1
""")
def dedup_keep_first_composite(t: Tables):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dedup.keep_first(t.lineitem.select(columns), columns[:2], columns[2:]).drop("l_extendedprice")


@query("dedup_full_row", """
SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
""")
def dedup_full_row(t: Tables):
    """Whole rows; every first line of an order comes twice."""
    return dedup.distinct_rows(t.lineitem.unionByName(t.lineitem.where("l_linenumber = 1")))


@query("duplicate_count", """
SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
""")
def duplicate_count(t: Tables):
    """Whole rows; every first line of an order comes twice."""
    return dedup.duplicate_count(t.lineitem.unionByName(t.lineitem.where("l_linenumber = 1")))


_TYPED_DIRTY = """(SELECT seq,
  CASE WHEN trim(etype_raw) NOT IN ('Unknown', '') THEN trim(etype_raw) END AS etype,
  TRY_CAST(value_raw AS DOUBLE) AS value,
  coalesce(try_strptime(when_raw, '%Y-%m-%d %H:%M:%S'), try_strptime(when_raw, '%m/%d/%Y')) AS moment,
  CASE flag_raw WHEN 'Yes' THEN true WHEN 'No' THEN false END AS flag
FROM dirty_events)"""


def _typed_dirty(t: Tables):
    return t.derived("dirty_events").select(
        "seq", c.null_unknown(F.col("etype_raw")).alias("etype"),
        c.to_number(F.col("value_raw")).alias("value"),
        c.to_timestamp_any(F.col("when_raw")).alias("moment"),
        c.map_values(F.col("flag_raw"), {"Yes": True, "No": False}).alias("flag"))


@query("null_profile", f"""
SELECT * FROM (
  SELECT 'etype' AS "column", count(*) - count(etype) AS nulls FROM {_TYPED_DIRTY}
  UNION ALL SELECT 'value', count(*) - count(value) FROM {_TYPED_DIRTY}
  UNION ALL SELECT 'moment', count(*) - count(moment) FROM {_TYPED_DIRTY}
  UNION ALL SELECT 'flag', count(*) - count(flag) FROM {_TYPED_DIRTY}) WHERE nulls > 0
""")
def null_profile(t: Tables):
    return profile.null_counts(_typed_dirty(t))


@query("table_profile", """
SELECT 'nation' AS "table", 0 AS position, 'n_nationkey' AS "column", 'int' AS type, count(*) AS rows, 3 AS columns FROM nation
UNION ALL SELECT 'nation', 1, 'n_name', 'string', count(*), 3 FROM nation
UNION ALL SELECT 'nation', 2, 'n_regionkey', 'int', count(*), 3 FROM nation
UNION ALL SELECT 'labels', 0, 'doc_id', 'bigint', count(*), 3 FROM labels
UNION ALL SELECT 'labels', 1, 'quality', 'int', count(*), 3 FROM labels
UNION ALL SELECT 'labels', 2, 'toxic', 'int', count(*), 3 FROM labels
""")
def table_profile(t: Tables):
    return profile.table_profile({"nation": t.nation, "labels": t.labels})


@query("missing_summary", f"""
SELECT 'events' AS "table", count(*) AS records, 5 AS columns,
  round((4 * count(*) - count(etype) - count(value) - count(moment) - count(flag)) * 100.0 / (5 * count(*)), 6) AS missing_pct
FROM {_TYPED_DIRTY}
UNION ALL SELECT 'orders', count(*), 6, 0.0 FROM orders
""")
def missing_summary(t: Tables):
    table = profile.missing_summary({"events": _typed_dirty(t), "orders": t.orders})
    return table.withColumn("missing_pct", r6("missing_pct"))
