"""Derived columns, group statistics on rows, encodings, text features, splits and weights."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt
from pyspark.sql.types import DoubleType

from tabula.catalog.registry import Tables, query, r6
from tabula.functions import numeric as num
from tabula.functions.cleaning import to_number
from tabula.functions.text import tokens
from tabula.operators import encode, groupwise, models, split, stats, textfeatures
from tabula.operators.sizing import stored
from tabula.plans.laps import LAP_TIME, lap_features, split_back, union_with_marker

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = ", ".join(LINE)

# Fixed value: a short stop-word list for the registered text queries; callers pass their own.
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "it", "that", "la", "le", "der", "die", "el"]
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


# ---- row expressions

@query("feature_arith", f"""
SELECT {LINE_SQL}, round(l_tax / (l_quantity + 1), 6) AS rate, round(l_quantity * l_discount / 100, 6) AS product,
  CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS guarded,
  l_linenumber * CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS conditional,
  CAST(year(l_shipdate) - 1995 AS INTEGER) AS year_offset
FROM lineitem
""")
def feature_arith(t: Tables):
    return t.lineitem.select(
        *LINE,
        r6(F.col("l_tax") / (F.col("l_quantity") + 1)).alias("rate"),
        r6(F.col("l_quantity") * F.col("l_discount") / 100).alias("product"),
        r6(F.try_divide(F.col("l_tax"), F.col("l_discount"))).alias("guarded"),
        (F.col("l_linenumber") * num.flag(F.col("l_returnflag") == "R")).alias("conditional"),
        (F.year("l_shipdate") - 1995).alias("year_offset"))


@query("feature_math", """
SELECT c_custkey, abs(c_acctbal) AS size, round(c_acctbal * c_acctbal, 2) AS squared,
  CASE WHEN c_acctbal > -1 THEN round(ln(1 + c_acctbal), 6) END AS logged FROM customer
""")
def feature_math(t: Tables):
    balance = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.abs(balance).alias("size"),
                             F.round(F.pow(balance, F.lit(2)), 2).alias("squared"),
                             r6(F.log1p(balance)).alias("logged"))


@query("feature_flags", f"""
SELECT {LINE_SQL}, CASE WHEN l_quantity <= 3 THEN 1 ELSE 0 END AS fresh,
  CASE WHEN l_extendedprice > 20000 THEN 1 ELSE 0 END AS pricey,
  CASE WHEN year(l_shipdate) = 1998 THEN 1 ELSE 0 END AS odd_year,
  CASE WHEN l_discount <> 0 AND l_tax / l_discount > 1 THEN 1 ELSE 0 END AS missing_is_zero
FROM lineitem
""")
def feature_flags(t: Tables):
    return t.lineitem.select(
        *LINE, num.flag(F.col("l_quantity") <= 3).alias("fresh"),
        num.flag(F.col("l_extendedprice") > 20000).alias("pricey"),
        num.flag(F.year("l_shipdate") == 1998).alias("odd_year"),
        num.flag(F.try_divide("l_tax", "l_discount") > 1).alias("missing_is_zero"))


@query("cut_right_closed", f"""
SELECT {LINE_SQL},
  CASE WHEN l_discount > 0 AND l_discount <= 0.01 THEN 0 WHEN l_discount > 0.01 AND l_discount <= 0.025 THEN 1
    WHEN l_discount > 0.025 AND l_discount <= 0.05 THEN 2 WHEN l_discount > 0.05 AND l_discount <= 0.1 THEN 3 END AS bucket,
  CASE WHEN l_discount >= 0 AND l_discount <= 0.05 THEN 0 WHEN l_discount > 0.05 AND l_discount <= 0.09 THEN 1 END AS closed
FROM lineitem
""")
def cut_right_closed(t: Tables):
    return t.lineitem.select(
        *LINE, num.cut(F.col("l_discount"), [0, 0.01, 0.025, 0.05, 0.1]).alias("bucket"),
        num.cut(F.col("l_discount"), [0, 0.05, 0.09], include_lowest=True).alias("closed"))


@query("regex_flag", """
SELECT p_partkey, CAST(regexp_full_match(upper(substr(p_name, 1, 4)), '[A-Z]{4}') AS INTEGER) AS named,
  length(p_name) AS characters FROM part
""")
def regex_flag(t: Tables):
    return t.part.select(
        "p_partkey", num.full_match(F.upper(F.substring("p_name", 1, 4)), "[A-Z]{4}").alias("named"),
        F.char_length("p_name").alias("characters"))


@query("select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_numeric(t: Tables):
    flagged = t.part.withColumn("big", F.col("p_size") > 25)
    return flagged.select(*stats.numeric_columns(flagged))


@query("rowwise_mean", f"""
SELECT {LINE_SQL}, round((l_discount + l_tax + l_quantity / 100) / 3, 6) AS mean,
  round(CASE WHEN l_discount > 0.05 THEN (l_discount + l_tax) / 2 ELSE l_tax END, 6) AS partial
FROM lineitem
""")
def rowwise_mean(t: Tables):
    discount, tax = F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        *LINE, r6(num.row_mean(discount, tax, F.col("l_quantity") / 100)).alias("mean"),
        r6(num.row_mean(F.when(discount > 0.05, discount), tax)).alias("partial"))


# ---- group statistics on rows

@query("is_last_in_group", f"""
SELECT {LINE_SQL}, CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) THEN 1 ELSE 0 END AS is_last
FROM lineitem
""")
def is_last_in_group(t: Tables):
    return groupwise.is_last(t.lineitem.select(*LINE), ["l_orderkey"], "l_linenumber", "is_last")


@query("group_mean_std", f"""
SELECT {LINE_SQL}, round(avg(l_quantity) OVER w, 6) AS "Order_Avg_Quantity", round(stddev_samp(l_quantity) OVER w, 6) AS "Order_Std_Quantity",
  round(avg(l_discount) OVER w, 10) AS "Order_Avg_Discount", round(stddev_samp(l_discount) OVER w, 6) AS "Order_Std_Discount"
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_returnflag)
""")
def group_mean_std(t: Tables):
    out = groupwise.mean_std(
        t.lineitem.select(*LINE, "l_returnflag", "l_quantity", "l_discount"), ["l_suppkey", "l_returnflag"],
        {"l_quantity": "Quantity", "l_discount": "Discount"}, "Order")
    names = [f"Order_{s}_{p}" for s in ("Avg", "Std") for p in ("Quantity", "Discount")]
    # means of two-decimal numbers often end in a 5 at the seventh place, so they keep ten
    return out.select(*LINE, *[
        (F.round(n, 10) if n == "Order_Avg_Discount" else r6(n)).alias(n) for n in names])


@query("remaining_in_group", f"""
SELECT {LINE_SQL}, m - l_linenumber AS remaining, round((m - l_linenumber) / m, 6) AS "remaining_Ratio"
FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_suppkey) AS m FROM lineitem)
""")
def remaining_in_group(t: Tables):
    out = groupwise.remaining(t.lineitem.select(*LINE), ["l_suppkey"], "l_linenumber", "remaining")
    return out.withColumn("remaining_Ratio", r6("remaining_Ratio"))


_RANK = """(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
    + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0) / count(*) OVER (PARTITION BY l_returnflag)"""


@query("pct_rank_avg", f"SELECT {LINE_SQL}, round({_RANK}, 6) AS rank FROM lineitem")
def pct_rank_avg(t: Tables):
    rows = t.lineitem.select(*LINE, "l_returnflag", "l_quantity")
    return groupwise.percent_rank(rows, "l_returnflag", "l_quantity", "rank").select(
        *LINE, r6("rank").alias("rank"))


@query("group_ratio_zscore", f"""
SELECT {LINE_SQL}, round(l_quantity / greatest(max(l_quantity) OVER w, 1), 6) AS ratio,
  round((l_quantity - avg(l_quantity) OVER w) / greatest(stddev_samp(l_quantity) OVER w, 1), 6) AS zscore
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)
""")
def group_ratio_zscore(t: Tables):
    rows = t.lineitem.select(*LINE, "l_returnflag", "l_quantity")
    out = groupwise.ratio_and_zscore(rows, "l_returnflag", "l_quantity", "ratio", "zscore")
    return out.select(*LINE, r6("ratio").alias("ratio"), r6("zscore").alias("zscore"))


@query("above_group_threshold", f"""
SELECT {LINE_SQL}, CASE WHEN l_quantity > 0.75 * avg(l_quantity) OVER (PARTITION BY l_returnflag) THEN 1 ELSE 0 END AS old
FROM lineitem
""")
def above_group_threshold(t: Tables):
    rows = t.lineitem.select(*LINE, "l_returnflag", "l_quantity")
    return groupwise.above_group_mean(rows, "l_returnflag", "l_quantity", 0.75, "old").select(*LINE, "old")


_LAP_SQL = """
SELECT id, "Year", "LapNumber", "Stint", "Position", "Position_Change", "PitNextLap",
  round("TyreLife", 6) AS "TyreLife", round("LapTime", 6) AS "LapTime (s)",
  round("Cumulative_Degradation", 6) AS "Cumulative_Degradation", round("RaceProgress", 6) AS "RaceProgress",
  CASE WHEN "Year" = 2023 THEN 1 ELSE 0 END AS "_is_2023",
  round("TyreLife" / greatest(max("TyreLife") OVER c, 1), 6) AS "TyreLife_Compound_Ratio",
  round(("TyreLife" - avg("TyreLife") OVER c) / greatest(stddev_samp("TyreLife") OVER c, 1), 6) AS "TyreLife_Zscore",
  round((rank() OVER (PARTITION BY "Compound" ORDER BY "TyreLife")
    + (count(*) OVER (PARTITION BY "Compound", "TyreLife") - 1) / 2.0) / count(*) OVER c, 6) AS "TyreLife_Compound_Rank",
  round("Cumulative_Degradation" / ("TyreLife" + 1), 6) AS "Degradation_Rate",
  round(abs("Cumulative_Degradation"), 6) AS "Deg_Abs",
  CASE WHEN "Stint" = max("Stint") OVER (PARTITION BY "Race", "Year", "Driver") THEN 1 ELSE 0 END AS "Is_Last_Stint",
  "LapNumber" * "LapNumber" AS "LapNumber_Squared", round(ln(1 + "LapNumber"), 6) AS "LapNumber_Log",
  round("RaceProgress" * "RaceProgress", 6) AS "RaceProgress_Squared",
  CASE WHEN "RaceProgress" > 0 AND "RaceProgress" <= 0.1 THEN 0 WHEN "RaceProgress" > 0.1 AND "RaceProgress" <= 0.25 THEN 1
    WHEN "RaceProgress" > 0.25 AND "RaceProgress" <= 0.5 THEN 2 WHEN "RaceProgress" > 0.5 AND "RaceProgress" <= 0.75 THEN 3
    WHEN "RaceProgress" > 0.75 AND "RaceProgress" <= 0.9 THEN 4 WHEN "RaceProgress" > 0.9 AND "RaceProgress" <= 1 THEN 5 END AS "RaceProgress_Bucket",
  abs("Position_Change") AS "Position_Change_Abs", "Position_Change" * "Position_Change" AS "Position_Change_Squared",
  CASE WHEN "Position_Change" = 0 THEN 1 ELSE 0 END AS "Is_Position_Stable",
  CASE WHEN "Position" <= 3 THEN 0 WHEN "Position" <= 5 THEN 1 WHEN "Position" <= 10 THEN 2 WHEN "Position" <= 15 THEN 3
    WHEN "Position" <= 20 THEN 4 END AS "Position_Bucket",
  round(ln(1 + "LapTime"), 6) AS "LapTime_Log", CASE WHEN "LapTime" > 130 THEN 1 ELSE 0 END AS "Is_Very_Slow_Lap",
  CASE WHEN "LapTime" > 200 THEN 1 ELSE 0 END AS "Is_Extreme_Lap",
  round("LapTime" * "TyreLife" / 100, 6) AS "LapTime_TyreLife",
  round("Stint" * "TyreLife", 6) AS "Stint_TyreLife",
  "Stint" * CASE WHEN "Compound" = 'HARD' THEN 1 ELSE 0 END AS "Stint_Hard",
  round("Position" * "RaceProgress", 6) AS "Pos_RaceProgress",
  CASE WHEN "TyreLife" <= 3 THEN 1 ELSE 0 END AS "Is_Fresh_Tyre",
  CASE WHEN "TyreLife" > 0.75 * avg("TyreLife") OVER c THEN 1 ELSE 0 END AS "Is_Old_Tyre",
  CASE WHEN "Driver" IN ('ABC', 'XYZ') THEN 1 ELSE 0 END AS "Driver_Is_Named", length("Driver") AS "Driver_Char_Count",
  round(avg("TyreLife") OVER r, 6) AS "Race_Avg_TyreLife", round(stddev_samp("TyreLife") OVER r, 6) AS "Race_Std_TyreLife",
  round(avg("LapTime") OVER r, 6) AS "Race_Avg_LapTime", round(stddev_samp("LapTime") OVER r, 6) AS "Race_Std_LapTime",
  round(avg("Cumulative_Degradation") OVER r, 6) AS "Race_Avg_Cumulative_Degradation",
  round(stddev_samp("Cumulative_Degradation") OVER r, 6) AS "Race_Std_Cumulative_Degradation",
  max("LapNumber") OVER r - "LapNumber" AS "Laps_Remaining",
  round((max("LapNumber") OVER r - "LapNumber") / (max("LapNumber") OVER r), 6) AS "Laps_Remaining_Ratio",
  CASE WHEN "Cumulative_Degradation" < 0 THEN 1 ELSE 0 END AS "Deg_Is_Negative",
  round("Year" * "TyreLife", 6) AS "Year_TyreLife", "Year" * "Stint" AS "Year_Stint",
  round("Year" * "RaceProgress", 6) AS "Year_RaceProgress",
  CASE "Compound" WHEN 'SOFT' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HARD' THEN 2 END AS "Compound_Encoded",
  CAST(dense_rank() OVER (ORDER BY "Driver") - 1 AS INTEGER) AS "Driver_Encoded",
  CAST(dense_rank() OVER (ORDER BY "Race") - 1 AS INTEGER) AS "Race_Encoded", "Year" - 2022 AS "Year_Encoded"
FROM laps WINDOW c AS (PARTITION BY "Compound"), r AS (PARTITION BY "Race", "Year")
"""


def laps_of(t: Tables):
    """The lap table: a projection of the given file, which is read where laps are needed and not written again."""
    return t.derived("laps").withColumnRenamed("LapTime", LAP_TIME)


@query("lap_features", _LAP_SQL)
def lap_feature_table(t: Tables):
    """Train and test stacked, all derived columns, both parts back together for the comparison."""
    laps = laps_of(t)
    train, test = laps.where(F.col("Stint") < 3), laps.where(F.col("Stint") == 3)
    first, second = split_back(lap_features(union_with_marker(train, test)))
    out = first.unionByName(second)
    return out.select(*[
        r6(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
        for f in out.schema.fields])


@query("union_split", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS target,
  CAST(o_orderkey % 3 > 0 AS INTEGER) AS is_train FROM orders
""")
def union_split(t: Tables):
    part = F.col("o_orderkey") % 3 > 0
    columns = ["o_orderkey", "o_totalprice"]
    train = t.orders.where(part).select(*columns, F.col("o_orderstatus").alias("target"))
    test = t.orders.where(~part).select(*columns)
    return union_with_marker(train, test).withColumn("is_train", F.col("is_train").cast("int"))


@query("merge_importances", """
WITH a AS (SELECT p_brand AS feature, sum(p_size) AS v FROM part GROUP BY 1),
b AS (SELECT p_brand AS feature, sum(p_retailprice) AS v FROM part WHERE p_brand <> 'Brand#1' GROUP BY 1)
SELECT a.feature, round(a.v / (SELECT sum(v) FROM a), 6) AS sizes, round(b.v / (SELECT sum(v) FROM b), 6) AS prices,
  round((a.v / (SELECT sum(v) FROM a) + b.v / (SELECT sum(v) FROM b)) / 2, 6) AS average
FROM a JOIN b ON a.feature = b.feature ORDER BY average DESC, a.feature LIMIT 20
""")
def merge_importances(t: Tables):
    sizes = t.part.groupBy(F.col("p_brand").alias("feature")).agg(
        F.sum("p_size").cast("double").alias("importance"))
    prices = t.part.where(F.col("p_brand") != "Brand#1").groupBy(
        F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("importance"))
    out = models.merge_importances({"sizes": sizes, "prices": prices}, k=20)
    return out.select("feature", *[r6(n).alias(n) for n in ("sizes", "prices", "average")])


@query("fold_average", """
SELECT o_orderkey AS id, round((o_totalprice / 997 + o_totalprice / 1999) / 2, 6) AS score FROM orders
""")
def fold_average(t: Tables):
    one = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 997).alias("score"))
    two = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1999).alias("score"))
    return models.average_folds([one, two], "id", "score").withColumn("score", r6("score"))


# ---- encodings

@query("label_encode", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code FROM part
""")
def label_encode(t: Tables):
    return encode.label_encode(t.part.select("p_partkey", "p_brand"), "p_brand", "code").select(
        "p_partkey", "code")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"""CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS "seg_{s}\"""" for s in _SEGMENTS) + " FROM customer")
def one_hot(t: Tables):
    return encode.one_hot(t.customer, "c_mktsegment", _SEGMENTS, "seg").select(
        "c_custkey", *[f"seg_{level}" for level in _SEGMENTS])


@query("topn_else_other", """
WITH top AS (SELECT source FROM documents WHERE doc_id % 7 > 0 GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 10)
SELECT doc_id, CASE WHEN doc_id % 7 > 0 AND source IN (SELECT source FROM top) THEN source ELSE 'other' END AS kept
FROM documents
""")
def topn_else_other(t: Tables):
    """Every seventh source is made missing, which also becomes ``other``."""
    rows = t.documents.select("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("source")).alias("source"))
    return encode.top_or_other(rows, "source", 10, "kept").select("doc_id", "kept")


@query("feature_block", """
SELECT seq, coalesce(TRY_CAST(value_raw AS DOUBLE), 0) AS value,
  CASE WHEN flag_raw = 'Yes' THEN 1 ELSE 0 END AS "flag_Yes", CASE WHEN flag_raw = 'No' THEN 1 ELSE 0 END AS "flag_No"
FROM dirty_events
""")
def feature_block(t: Tables):
    """Numeric block with zeros for missing values, one-hots, as a vector and back to columns."""
    typed = t.derived("dirty_events").select("seq", "flag_raw", to_number(F.col("value_raw")).alias("value"))
    wide = encode.one_hot(typed, "flag_raw", ["Yes", "No"], "flag")
    block = models.assemble(wide, ["value", "flag_Yes", "flag_No"], "features")
    cells = vector_to_array("features")
    return block.select("seq", cells[0].alias("value"), cells[1].cast("int").alias("flag_Yes"),
                        cells[2].cast("int").alias("flag_No"))


@query("standardize", f"""
SELECT {LINE_SQL}, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity_scaled,
  0.0::DOUBLE AS constant_scaled FROM lineitem
""")
def standardize(t: Tables):
    rows = t.lineitem.select(*LINE, "l_quantity", F.lit(3.0).alias("constant"))
    out = encode.standardize(rows, ["l_quantity", "constant"])
    return out.select(*LINE, r6("l_quantity_scaled").alias("l_quantity_scaled"), "constant_scaled")


# ---- text features

_WORDS = rf"""(SELECT doc_id, [w for w in regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')
  if w NOT IN ({_STOP_SQL})] AS words FROM documents)"""
_TERMS = f"""(SELECT doc_id, unnest(list_concat(words, [words[i] || ' ' || words[i + 1] for i in range(1, len(words))])) AS term
  FROM {_WORDS})"""


@query("tokenize", f"SELECT doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest FROM {_WORDS}")
def tokenize(t: Tables):
    words = t.spread("documents").select("doc_id", tokens(F.col("text"), STOP_WORDS).alias("words"))
    return words.select("doc_id", F.size("words").alias("n"),
                        F.md5(F.array_join("words", " ")).alias("digest"))


@query("ngrams", f"SELECT doc_id, term, count(*) AS n FROM {_TERMS} GROUP BY ALL")
def ngrams(t: Tables):
    counts = textfeatures.term_counts(t.documents, "doc_id", "text", STOP_WORDS, bigrams=True)
    return counts.withColumnRenamed("count", "n")


_VOCAB = f"""(SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM {_TERMS} GROUP BY 1
  HAVING count(DISTINCT doc_id) <= 0.8 * (SELECT count(*) FROM documents) ORDER BY tf DESC, term LIMIT 500)"""


@query("vocab_topn", f"SELECT term, df, tf FROM {_VOCAB}")
def vocab_topn(t: Tables):
    counts = textfeatures.term_counts(t.documents, "doc_id", "text", STOP_WORDS, bigrams=True)
    frequency = textfeatures.document_frequency(counts, "doc_id")
    documents = t.documents.agg(F.count(F.lit(1))).scalar()
    return textfeatures.vocabulary(frequency, documents, 500, 0.8)


@query("tfidf", f"""
WITH vocab AS {_VOCAB}, counts AS (SELECT doc_id, term, count(*) AS c FROM {_TERMS} GROUP BY ALL),
raw AS (SELECT doc_id, counts.term, (1 + ln(c)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM counts JOIN vocab ON counts.term = vocab.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw
""")
def tfidf(t: Tables):
    counts = textfeatures.term_counts(t.documents, "doc_id", "text", STOP_WORDS, bigrams=True)
    documents = t.documents.agg(F.count(F.lit(1))).scalar()
    vocabulary = textfeatures.vocabulary(
        textfeatures.document_frequency(counts, "doc_id"), documents, 500, 0.8)
    return textfeatures.tfidf(counts, "doc_id", vocabulary, documents).withColumn("weight", r6("weight"))


@query("tfidf_all_terms", rf"""
WITH counts AS (SELECT doc_id, word AS term, count(*) AS c FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM documents) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM counts GROUP BY 1),
raw AS (SELECT doc_id, counts.term, (1 + ln(c)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM counts JOIN df ON counts.term = df.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw
""")
def tfidf_all_terms(t: Tables):
    counts = textfeatures.term_counts(t.documents, "doc_id", "text")
    documents = t.documents.agg(F.count(F.lit(1))).scalar()
    frequency = textfeatures.document_frequency(counts, "doc_id")
    return textfeatures.tfidf(counts, "doc_id", frequency, documents).withColumn("weight", r6("weight"))


@query("tfidf_vectors_sparse", f"""
WITH vocab AS {_VOCAB}, counts AS (SELECT doc_id, term, count(*) AS c FROM {_TERMS} GROUP BY ALL),
slots AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS slot FROM vocab),
raw AS (SELECT doc_id, slot, (1 + ln(c)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM counts JOIN slots ON counts.term = slots.term)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw
""")
def tfidf_vectors_sparse(t: Tables):
    """Slots and weights of the stored sparse vectors."""
    rows, _ = textfeatures.tfidf_vectors(t.documents.select("doc_id", "text"), "doc_id", "text", 500, "v", STOP_WORDS, max_df=0.8)
    parts = unwrap_udt(F.col("v"))
    return rows.select("doc_id", F.explode(F.arrays_zip(parts["indices"].alias("slot"), parts["values"].alias("weight"))).alias("e")).select(
        "doc_id", F.col("e.slot").alias("slot"), r6(F.col("e.weight")).alias("weight"))


# ---- splits and weights

_ORDERED = """(SELECT doc_id, quality, row_number() OVER (PARTITION BY quality
  ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)"""


@query("stratified_split", f"""
SELECT doc_id, quality, CASE WHEN r <= round(n * 0.2) THEN 1 ELSE 0 END AS is_test FROM {_ORDERED}
""")
def stratified_split(t: Tables):
    return split.stratified_split(t.labels.select("doc_id", "quality"), "doc_id", "quality", 0.2)


@query("stratified_folds", f"SELECT doc_id, quality, CAST((r - 1) % 5 AS INTEGER) AS fold FROM {_ORDERED}")
def stratified_folds(t: Tables):
    return split.stratified_folds(t.labels.select("doc_id", "quality"), "doc_id", "quality", 5)


@query("balanced_weights", """
SELECT doc_id, toxic, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT toxic) FROM labels)
  * count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM labels
""")
def balanced_weights(t: Tables):
    out = split.balanced_weights(t.labels.select("doc_id", "toxic"), "toxic")
    return out.withColumn("weight", r6("weight"))


@query("sample_weights", f"""
WITH r AS (SELECT count(*) FILTER (l_linestatus = 'O') / greatest(count(*) FILTER (l_linestatus = 'F'), 1) AS ratio
  FROM lineitem WHERE year(l_shipdate) <> 1998)
SELECT {LINE_SQL}, CASE WHEN year(l_shipdate) <> 1998 AND l_linestatus = 'F' THEN round(ratio * 0.5, 6) ELSE 1 END AS weight
FROM lineitem, r
""")
def sample_weights(t: Tables):
    rows = t.lineitem.select(*LINE, "l_shipdate", num.flag(F.col("l_linestatus") == "F").alias("y"))
    out = split.positive_weights(rows, "y", F.year("l_shipdate") == 1998)
    return out.select(*LINE, r6("weight").alias("weight"))
