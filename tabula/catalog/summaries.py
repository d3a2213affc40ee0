"""Frequencies, shares, statistics and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.catalog.registry import Tables, query, r6
from tabula.functions import cleaning as c
from tabula.functions import numeric as num
from tabula.operators import freq, stats, timeline
from tabula.functions.text import tokens

PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


# ---- frequencies

@query("topk_values", """
SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 15
""")
def topk_values(t: Tables):
    return freq.top_values(t.part, "p_brand", 15)


@query("explode_topk", r"""
SELECT word AS value, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents)
GROUP BY 1 ORDER BY n DESC, value LIMIT 25
""")
def explode_topk(t: Tables):
    return freq.top_elements(t.spread("documents").select(tokens(F.col("text")).alias("words")), "words", 25)


@query("explode_topk_names", """
SELECT word AS value, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
GROUP BY 1 ORDER BY n DESC, value LIMIT 5
""")
def explode_topk_names(t: Tables):
    return freq.top_elements(t.part.select(F.split("p_name", " ").alias("words")), "words", 5)


@query("value_counts", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def value_counts(t: Tables):
    return freq.value_counts(t.events, "event_type")


@query("value_counts_with_null", """
SELECT CASE flag_raw WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS value, count(*) AS n FROM dirty_events GROUP BY 1
""")
def value_counts_with_null(t: Tables):
    typed = t.derived("dirty_events").select(
        c.map_values(F.col("flag_raw"), {"Yes": True, "No": False}).cast("int").alias("flag"))
    return freq.value_counts(typed, "flag", keep_null=True)


@query("year_distribution", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1
""")
def year_distribution(t: Tables):
    years = t.orders.select(F.year("o_orderdate").alias("year"))
    return freq.value_counts(years, "year", name="year").orderBy("year")


@query("share_by_category", """
SELECT tag AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share
FROM (SELECT CASE WHEN trim(etype_raw) NOT IN ('Unknown', '') THEN trim(etype_raw) END AS tag FROM dirty_events)
WHERE tag IS NOT NULL GROUP BY 1
""")
def share_by_category(t: Tables):
    typed = t.derived("dirty_events").select(c.null_unknown(F.col("etype_raw")).alias("tag"))
    return freq.share_by(typed, "tag").withColumn("share", r6("share"))


@query("severity_distribution", """
SELECT o_orderpriority AS value, count(*) AS n, 5 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
  round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY 1, 3
""")
def severity_distribution(t: Tables):
    out = freq.ordered_share(t.orders, "o_orderpriority", [*PRIORITIES, "0-NEVER"])
    return out.withColumn("share", r6("share"))


_YEARLY = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total,
  count(*) FILTER (o_orderpriority = '1-URGENT') AS flagged,
  round(count(*) FILTER (o_orderpriority = '1-URGENT') * 100.0 / count(*), 6) AS flagged_pct
FROM orders GROUP BY 1
"""


def _yearly(t: Tables):
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    out = freq.counts_with_flag(orders, "year", "o_orderkey", F.col("o_orderpriority") == "1-URGENT")
    return out.withColumn("flagged_pct", r6("flagged_pct"))


@query("yearly_with_flag", f"SELECT year, total, flagged FROM ({_YEARLY})")
def yearly_with_flag(t: Tables):
    return _yearly(t).drop("flagged_pct")


@query("flag_rate_by_year", f"SELECT year, flagged_pct FROM ({_YEARLY})")
def flag_rate_by_year(t: Tables):
    return _yearly(t).select("year", "flagged_pct")


@query("distinct_counts", """
SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
""")
def distinct_counts(t: Tables):
    return t.lineitem.agg(F.count_distinct("l_partkey").alias("parts"),
                          F.count_distinct("l_suppkey").alias("suppliers"))


@query("kpi_scalars", """
SELECT 'rows' AS indicator, CAST(count(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'largest', max(o_totalprice) FROM orders
UNION ALL SELECT 'urgent', CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) FROM orders
UNION ALL SELECT 'absent level', 0.0
""")
def kpi_scalars(t: Tables):
    level = F.col("o_orderpriority")
    return freq.indicators(t.orders, {
        "rows": F.count(F.lit(1)), "largest": F.max("o_totalprice"),
        "urgent": F.count_if(level == "1-URGENT"), "absent level": F.count_if(level == "0-NEVER")})


@query("class_balance", """
SELECT quality, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY 1
""")
def class_balance(t: Tables):
    return freq.class_balance(t.labels, "quality").withColumn("share", r6("share"))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("crosstab_counts", "SELECT o_orderstatus, " + ", ".join(
    f"""count(*) FILTER (o_orderpriority = '{p}') AS "p_{p}\"""" for p in [*_PRIORITIES, "0-NEVER"])
    + " FROM orders GROUP BY 1")
def crosstab_counts(t: Tables):
    """All five levels, and one that no row has."""
    return freq.crosstab(t.orders, "o_orderstatus", "o_orderpriority", [*_PRIORITIES, "0-NEVER"], prefix="p_")


@query("crosstab_row_pct", """
SELECT p_type, round(avg(CASE WHEN p_size % 2 = 0 THEN 100.0 ELSE 0.0 END), 6) AS even_true,
  round(avg(CASE WHEN p_size % 2 = 0 THEN 0.0 ELSE 100.0 END), 6) AS even_false
FROM part GROUP BY 1
""")
def crosstab_row_pct(t: Tables):
    parts = t.part.select("p_type", F.when(F.col("p_size") % 2 == 0, "true").otherwise("false").alias("even"))
    out = freq.crosstab_percent(parts, "p_type", "even", ["true", "false"], prefix="even_")
    return out.select("p_type", r6("even_true").alias("even_true"), r6("even_false").alias("even_false"))


_NATIONS = [f"nation {i}" for i in [*range(25), 99]]


@query("severity_compare", f"""
SELECT level, CAST(position AS INTEGER) AS position, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers
FROM (SELECT unnest({_NATIONS}) AS level, unnest(range({len(_NATIONS)})) AS position)
LEFT JOIN (SELECT 'nation ' || c_nationkey AS level, count(*) AS n FROM customer GROUP BY 1) AS c USING (level)
LEFT JOIN (SELECT 'nation ' || s_nationkey AS level, count(*) AS n FROM supplier GROUP BY 1) AS s USING (level)
""")
def severity_compare(t: Tables):
    """All 25 nations, and one that no row has."""
    nation = F.lit("nation ")
    return freq.compare_levels({
        "customers": t.customer.select(F.concat(nation, F.col("c_nationkey").cast("string")).alias("level")),
        "suppliers": t.supplier.select(F.concat(nation, F.col("s_nationkey").cast("string")).alias("level")),
    }, "level", _NATIONS)


@query("dataset_share", """
SELECT "table", n, round(n * 100.0 / sum(n) OVER (), 6) AS share FROM (
  SELECT 'part' AS "table", count(*) AS n FROM part UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'events', count(*) FROM events)
""")
def dataset_share(t: Tables):
    out = freq.table_shares({"part": t.part, "orders": t.orders, "events": t.events})
    return out.withColumn("share", r6("share"))


# ---- statistics

@query("group_stats", """
SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
  max(l_quantity) AS max FROM lineitem GROUP BY 1
""")
def group_stats(t: Tables):
    out = stats.group_summary(t.lineitem, ["l_returnflag"], "l_quantity")
    return out.select("l_returnflag", r6("mean").alias("mean"), r6("std").alias("std"), "max")


@query("median_exact", """
SELECT round(median(l_extendedprice), 6) AS price, (SELECT round(median(o_totalprice), 6) FROM orders) AS total
FROM lineitem
""")
def median_exact(t: Tables):
    price = stats.median(t.lineitem, "l_extendedprice")
    return price.select(r6("median").alias("price"),
                        r6(stats.median(t.orders, "o_totalprice").scalar()).alias("total"))


@query("median_by_group", """
SELECT l_returnflag, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1
""")
def median_by_group(t: Tables):
    out = stats.median(t.lineitem, "l_extendedprice", ["l_returnflag"])
    return out.withColumn("median", r6("median"))


@query("describe_numeric", """
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.75), 6) AS p75,
  max(l_extendedprice) AS max FROM lineitem
""")
def describe_numeric(t: Tables):
    out = stats.describe(t.lineitem, "l_extendedprice")
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4),
                            **{p: r6(p) for p in ("p25", "p50", "p75")}})


def _response_days(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(num.whole_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))


_DAYS = """(SELECT CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("overdue_share", f"""
SELECT count(*) FILTER (days > 14) AS overdue, round(count(*) FILTER (days > 14) * 100.0 / count(*), 6) AS overdue_pct
FROM {_DAYS} WHERE days >= 0 AND days < 60
""")
def overdue_share(t: Tables):
    days = _response_days(t).where((F.col("days") >= 0) & (F.col("days") < 60))
    late = F.count_if(F.col("days") > 14)
    return days.agg(late.alias("overdue"), r6(num.percent(late, F.count(F.lit(1)))).alias("overdue_pct"))


def _histogram_sql(source: str, value: str, bins: int) -> str:
    return f"""
WITH limits AS (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi FROM {source}),
grid AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS a, lo + (i + 1) * ((hi - lo) / {bins}) AS b
  FROM limits, range({bins}) AS r(i))
SELECT bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end,
  (SELECT count(*) FROM {source} WHERE {value} >= a AND ({value} < b OR bin = {bins - 1})) AS n
FROM grid"""


def rounded_bins(df):
    return df.withColumns({"bin_start": r6("bin_start"), "bin_end": r6("bin_end")})


@query("histogram", _histogram_sql("lineitem", "l_extendedprice", 30))
def histogram(t: Tables):
    return rounded_bins(stats.histogram(t.lineitem, "l_extendedprice", 30))


@query("days_between_hist", _histogram_sql(
    f"(SELECT * FROM {_DAYS} WHERE days >= 0 AND days < 60)", "days", 30))
def days_between_hist(t: Tables):
    days = _response_days(t).where((F.col("days") >= 0) & (F.col("days") < 60))
    return rounded_bins(stats.histogram(days, "days", 30))


@query("histogram_by_group", """
WITH limits AS (SELECT p_type, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1),
grid AS (SELECT p_type, CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 20) AS a, lo + (i + 1) * ((hi - lo) / 20) AS b
  FROM limits, range(20) AS r(i))
SELECT g.p_type, bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end, count(p_partkey) AS n
FROM grid g LEFT JOIN part p ON p.p_type = g.p_type AND p_retailprice >= a AND (p_retailprice < b OR bin = 19)
GROUP BY ALL
""")
def histogram_by_group(t: Tables):
    return rounded_bins(stats.histogram_by(t.part, "p_type", "p_retailprice", 20))


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
    for a in _NUMERIC for b in _NUMERIC) + """
UNION ALL SELECT a, b, NULL FROM (VALUES ('constant', 'l_quantity'), ('constant', 'l_extendedprice'),
  ('constant', 'l_discount'), ('constant', 'l_tax'), ('l_quantity', 'constant'), ('l_extendedprice', 'constant'),
  ('l_discount', 'constant'), ('l_tax', 'constant'), ('constant', 'constant')) AS v(a, b)""")
def corr_matrix(t: Tables):
    """All pairs, with one constant column whose correlations are missing."""
    rows = t.lineitem.select(*_NUMERIC, F.lit(1.0).alias("constant"), "l_returnflag")
    return stats.correlation_matrix(rows).withColumn("correlation", r6("correlation"))


@query("corr_with_target", """
SELECT feature, round(abs(c), 6) AS abs_correlation FROM (
  SELECT 'l_quantity' AS feature, corr(l_quantity, y) AS c FROM (SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem)
  UNION ALL SELECT 'l_discount', corr(l_discount, y) FROM (SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem)
  UNION ALL SELECT 'l_tax', corr(l_tax, y) FROM (SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem)
  UNION ALL SELECT 'l_extendedprice', corr(l_extendedprice, y) FROM (SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem)
)
""")
def corr_with_target(t: Tables):
    rows = t.lineitem.select(*_NUMERIC, num.flag(F.col("l_returnflag") == "R").alias("y"))
    return stats.correlation_with(rows, "y", len(_NUMERIC)).withColumn("abs_correlation", r6("abs_correlation"))


# ---- time series

@query("monthly_counts", """
WITH months AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1)
SELECT last_day(g::DATE) AS period, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series((SELECT min(m) FROM months)::TIMESTAMP, (SELECT max(m) FROM months)::TIMESTAMP,
  INTERVAL 1 MONTH)) AS g) LEFT JOIN months ON m = g::DATE
""")
def monthly_counts(t: Tables):
    return timeline.monthly_counts(t.orders, "o_orderdate")


_DAILY = """
WITH days AS (SELECT ts::DATE AS d, count(*) AS n FROM {source} GROUP BY 1)
SELECT g::DATE AS period, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series((SELECT min(d) FROM days)::TIMESTAMP, (SELECT max(d) FROM days)::TIMESTAMP,
  INTERVAL 1 DAY)) AS g) LEFT JOIN days ON d = g::DATE
"""


@query("daily_counts", _DAILY.format(source="events"))
def daily_counts(t: Tables):
    return timeline.daily_counts(t.events, "ts")


@query("daily_counts_gaps", _DAILY.format(
    source="(SELECT o_orderdate AS ts FROM orders WHERE o_totalprice > 400000)"))
def daily_counts_gaps(t: Tables):
    """Large orders only, so that some days are empty."""
    return timeline.daily_counts(t.orders.where(F.col("o_totalprice") > 400000), "o_orderdate")


@query("burst_days", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, day LIMIT 5
""")
def burst_days(t: Tables):
    return timeline.burst_days(t.orders, "o_orderdate")
