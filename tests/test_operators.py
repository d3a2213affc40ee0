import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import dedup, encode, freq, groupwise, models, profile, sizing, split, stats, timeline
from tabula.operators.textfeatures import (
    document_frequency, term_counts, tfidf, tfidf_vectors, vocabulary)
from tabula.plans import tasks


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def tiny_limits(monkeypatch):
    """Force the large-input paths: no broadcast, sliced running sums."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(sizing, "WINDOW_ROWS", 20)


def skewed(spark, n=600, seed=3):
    """Rows of three groups, one holding most of them, with many ties."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 else f"g{i % 2}", float(rng.randrange(40)) / 4) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, x double").repartition(7), rows


# ---- sizing

@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_paths_agree(spark, descending):
    rows = [(g, x, (x * 7) % 5 + 1) for g in ("a", "b") for x in range(150 if g == "a" else 9)]
    cells = spark.createDataFrame(rows, "g string, x long, n long").repartition(5)

    def run(limit):
        out = sizing.running_sums(cells, ["g"], "x", {"n": "upto"}, totals={"n": "all"},
                                  descending=descending, window_rows=limit)
        return sorted(map(tuple, out.collect()))

    small, large = run(10_000), run(16)
    assert small == large
    expected = {}
    for g in ("a", "b"):
        total = 0
        for _, x, n in sorted([r for r in rows if r[0] == g], key=lambda r: r[1], reverse=descending):
            total += n
            expected[g, x] = total
    assert {(g, x): upto for g, x, _, upto, _ in large} == expected
    assert {(g, a) for g, *_, a in large} == {
        (g, sum(n for h, _, n in rows if h == g)) for g in ("a", "b")}


def test_running_sums_without_groups_in_slices(spark):
    cells = spark.range(200).select(F.col("id").alias("x"), F.lit(1).alias("n"))
    out = sizing.running_sums(cells, [], "x", {"n": "upto"}, window_rows=16)
    assert sorted((r.x, r.upto) for r in out.collect()) == [(i, i + 1) for i in range(200)]


def test_slices_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_SLICES", 3)
    cells = spark.range(300).select(F.col("id").alias("x"), F.lit(2).alias("n"))
    out = sizing.running_sums(cells, [], "x", {"n": "upto"}, totals={"n": "all"}, window_rows=4)
    assert sorted((r.x, r.upto, r["all"]) for r in out.collect()) == [(i, 2 * i + 2, 600) for i in range(300)]


def test_attach_broadcasts_only_small_lookups(spark):
    rows = spark.range(50).withColumn("k", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = sizing.attach(rows, lookup, "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sizing.attach(rows, lookup, "k", broadcast_bytes=2)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- duplicates and profiles

def test_keep_first_treats_nulls_as_equal_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w")],
                               "k string, o int, v string")
    first = dedup.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, first.collect()), key=repr) == [("a", 1, "y"), (None, 4, "w")]
    assert first.columns == df.columns
    assert plan(first).count("WindowGroupLimit") >= 2


def test_keep_first_ignores_partitioning(spark):
    rows = [(i % 10, i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    one = sorted(map(tuple, dedup.keep_first(df.coalesce(1), ["k"], ["o"]).collect()))
    many = sorted(map(tuple, dedup.keep_first(df.repartition(9), ["k"], ["o"]).collect()))
    assert one == many == [(k, k, f"v{k}") for k in range(10)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    assert tuple(dedup.duplicate_count(df).first()) == (3, 1)
    assert tuple(dedup.duplicate_count(df.limit(0)).first()) == (0, 0)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, []), (None, None, ["x"])], "a int, b string, c array<string>")
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("a", 1), ("b", 2)}
    assert profile.total_nulls(df).first()[0] == 3
    got = {r["table"]: r for r in profile.missing_summary({"t": df, "none": df.limit(0)}).collect()}
    assert got["t"]["missing_pct"] == pytest.approx(50.0) and got["none"]["missing_pct"] == 0.0
    assert [r["type"] for r in profile.table_profile({"t": df}).orderBy("position").collect()] == [
        "int", "string", "array<string>"]


# ---- frequencies

def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    assert [tuple(r) for r in freq.top_values(df, "t", 2).collect()] == [("c", 2), ("a", 1)]


def test_elements_are_trimmed_and_blanks_dropped(spark):
    df = spark.createDataFrame([([" a ", "", None, "b"],), (["a", " "],), ([],), (None,)], "x array<string>")
    assert [tuple(r) for r in freq.top_elements(df, "x", 5).collect()] == [("a", 2), ("b", 1)]


def test_shares_sum_to_hundred(spark):
    df, _ = skewed(spark)
    assert sum(r["share"] for r in freq.share_by(df, "g").collect()) == pytest.approx(100)


def test_ordered_share_leaves_unknown_levels_out(spark):
    df = spark.createDataFrame([("Low",), ("High",), ("High",), ("odd",), (None,)], "s string")
    got = {r["value"]: (r["level"], round(r["share"], 3)) for r in freq.ordered_share(df, "s", ["Low", "Mid", "High"]).collect()}
    assert got == {"Low": (0, 33.333), "High": (2, 66.667)}


def test_crosstab_drops_missing_and_fills_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("b", "y")], "r string, c string")
    got = {r["r"]: (r["x"], r["y"], r["z"]) for r in freq.crosstab(df, "r", "c", ["x", "y", "z"]).collect()}
    assert got == {"a": (1, 0, 0), "b": (0, 1, 0)}


# ---- statistics

def test_histogram_counts_and_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert [r["n"] for r in stats.histogram(df, "x", 3).orderBy("bin").collect()] == [1, 1, 2]


def test_histogram_of_one_value_is_widened(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    rows = stats.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r["bin_start"], r["bin_end"], r["n"]) for r in rows] == [(4.5, 5.0, 0), (5.0, 5.5, 2)]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = np.round(rng.normal(size=500), 2)
    df = spark.createDataFrame([(float(v),) for v in data], "x double").repartition(6)
    got = [r["n"] for r in stats.histogram(df, "x", 17).orderBy("bin").collect()]
    assert got == list(np.histogram(data, 17)[0])


@pytest.mark.parametrize("large", [False, True])
def test_quantiles_match_numpy(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(sizing, "WINDOW_ROWS", 20)
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    df, rows = skewed(spark)
    points = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)] for r in stats.quantiles(df, "x", points, ["g"]).collect()}
    for g in {r[1] for r in rows}:
        assert got[g] == pytest.approx(list(np.quantile([r[2] for r in rows if r[1] == g], points)))
    assert stats.median(df, "x").first()[0] == pytest.approx(np.median([r[2] for r in rows]))


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    row = stats.describe(df, "x").first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (4, 2.5, 1.75, 2.5, 3.25)
    assert row["std"] == pytest.approx(math.sqrt(5 / 3))


def test_correlation_is_pairwise_complete_and_survives_constants(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, 4.1, 1.0), (3.0, None, 1.0), (4.0, 7.9, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double")
    got = {(r[0], r[1]): r[2] for r in stats.correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7.9])[0, 1])
    assert got["a", "k"] is None and got["a", "a"] == pytest.approx(1.0)
    assert stats.correlation_matrix(df, ["a", "b"]).count() == 0


def test_booleans_are_not_numeric(spark):
    df = spark.createDataFrame([(1, True, "x")], "a int, b boolean, c string")
    assert stats.numeric_columns(df) == ["a"]


def test_months_are_filled(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5),), (dt.datetime(2024, 3, 1),), (None,)], "t timestamp")
    got = [(r["period"], r["n"]) for r in timeline.monthly_counts(df, "t").orderBy("period").collect()]
    assert got == [(dt.date(2024, 1, 31), 1), (dt.date(2024, 2, 29), 0), (dt.date(2024, 3, 31), 1)]


def test_burst_days_prefer_earlier(spark):
    days = [1, 1, 2, 2, 3]
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in days], "t timestamp")
    assert [r["day"] for r in timeline.burst_days(df, "t", 2).collect()] == ["2024-01-01", "2024-01-02"]


# ---- group statistics on rows

def test_percent_rank_shares_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 3), ("a", None)], "g string, x int")
    got = sorted([r["r"] for r in groupwise.percent_rank(df, "g", "x", "r").collect()], key=lambda v: (v is None, v))
    assert got == [0.25, 0.625, 0.625, 1.0, None]


def test_percent_rank_large_path(spark, tiny_limits):
    df, rows = skewed(spark)
    got = {r["id"]: r["r"] for r in groupwise.percent_rank(df, "g", "x", "r").collect()}
    for g in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == g]
        for i, _, x in mine:
            below = sum(1 for r in mine if r[2] < x)
            same = sum(1 for r in mine if r[2] == x)
            assert got[i] == pytest.approx((below + (same + 1) / 2) / len(mine))


def test_group_of_one_has_no_zscore(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    got = {(r["g"], r["x"]): (r["q"], r["z"]) for r in groupwise.ratio_and_zscore(df, "g", "x", "q", "z").collect()}
    assert got["a", 5.0] == (1.0, None)
    assert got["b", 1.0][1] == pytest.approx(-1 / math.sqrt(2))


def test_null_group_keys_get_nothing(spark):
    df = spark.createDataFrame([(None, 5.0), ("b", 1.0)], "g string, x double")
    got = {r["g"]: r["m"] for r in groupwise.with_group(df, ["g"], {"m": F.max("x")}).collect()}
    assert got == {None: None, "b": 1.0}


def test_remaining_and_last(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4)], "g string, x int")
    got = sorted(tuple(r) for r in groupwise.remaining(df, ["g"], "x", "left").select("x", "left", "left_Ratio").collect())
    assert got == [(1, 3, 0.75), (4, 0, 0.0)]
    assert sorted((r["x"], r["l"]) for r in groupwise.is_last(df, ["g"], "x", "l").collect()) == [(1, 0), (4, 1)]


# ---- encodings

def test_top_or_other_counts_null_as_other(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "t string")
    assert sorted(r["k"] for r in encode.top_or_other(df, "t", 2, "k").collect()) == [
        "a", "a", "b", "b", "other", "other"]


def test_one_hot_and_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    assert [(r["p_a"], r["p_b"]) for r in encode.one_hot(df, "t", ["a", "b"], "p").collect()] == [(0, 1), (1, 0), (0, 0)]
    got = {r["t"]: r["c"] for r in encode.label_encode(df, "t", "c").collect()}
    assert got == {"a": 0, "b": 1, None: None}
    unseen = encode.label_encode(df, "t", "c", fit_on=df.where("t = 'b'"))
    assert {r["t"]: r["c"] for r in unseen.collect()} == {"b": 0, "a": None, None: None}


def test_levels_refuse_wide_columns(spark):
    with pytest.raises(ValueError):
        encode.levels_of(spark.range(20).select(F.col("id").cast("string").alias("t")), "t", limit=10)


def test_one_hot_vector_takes_any_number_of_levels(spark):
    n = 10_050
    df = spark.range(n + 1).select("id", F.when(F.col("id") < n, F.format_string("c%06d", "id")).alias("t"))
    wide, levels = encode.one_hot_vector(df, "t", "v", "p")
    got = {r["id"]: r["v"] for r in wide.where("id in (0, 7, 10049, 10050)").collect()}
    assert levels.size == n and {len(v) for v in got.values()} == {n}
    assert {i: list(v.indices) for i, v in got.items()} == {0: [0], 7: [7], 10_049: [10_049], 10_050: []}
    names = encode.slot_names(spark, ["x", levels, "y"])
    assert sorted(tuple(r) for r in names.where("slot in (0, 1, 8, 10050, 10051)").collect()) == [
        (0, "x"), (1, "p_c000000"), (8, "p_c000007"), (10_050, "p_c010049"), (10_051, "y")]
    empty, none = encode.one_hot_vector(df.where("t is null"), "t", "v", "p")
    assert none.size == 0 and len(empty.first()["v"]) == 0


def test_severity_features_have_no_level_limit(spark):
    ips = spark.range(10_020).select(
        F.col("id").alias("IP"), F.format_string("c%06d", "id").alias("Continent"), F.lit("x").alias("Threat_Label"),
        F.lit("Low").alias("Threat_Severity"))
    wide, columns = tasks.ip_block(ips)[:2]
    assert len(models.assemble(wide, columns[-2:]).first()["features"]) == 10_021


def test_standardize_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, k double")
    got = [tuple(r) for r in encode.standardize(df, ["x", "k"]).select("x_scaled", "k_scaled").collect()]
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_drop_rare(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 5, "t string")
    assert [r["t"] for r in encode.drop_rare(df, "t", 3).collect()] == ["a"] * 3


# ---- text features

DOCS = [(1, "red apple red"), (2, "green apple"), (3, "red"), (4, "!")]


def brute_tfidf(docs):
    counts = {d: {} for d, _ in docs}
    for d, text in docs:
        for w in text.replace("!", "").split():
            counts[d][w] = counts[d].get(w, 0) + 1
    n, df = len(docs), {}
    for words in counts.values():
        for w in words:
            df[w] = df.get(w, 0) + 1
    out = {}
    for d, words in counts.items():
        raw = {w: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in words.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(d, w): v / length for w, v in raw.items()})
    return out


@pytest.mark.parametrize("large", [False, True])
def test_tfidf_matches_brute_force(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame(DOCS, "d long, t string")
    counts = term_counts(df, "d", "t")
    got = tfidf(counts, "d", document_frequency(counts, "d"), F.lit(len(DOCS)))
    assert {(r["d"], r["term"]): r["weight"] for r in got.collect()} == pytest.approx(brute_tfidf(DOCS))


def test_wide_vocabulary_is_bounded_by_the_texts(spark):
    """100,000 terms: a row holds its own entries only, and vectors go into an assembler as they are."""
    words = " ".join(f"w{i:06d}" for i in range(100_000))
    df = spark.createDataFrame([(i, words[i * 8_000: (i + 1) * 8_000 - 1]) for i in range(100)] + [(100, None), (101, "")], "d int, t string")
    out, terms = tfidf_vectors(df, "d", "t", 200_000, "v", bigrams=False)
    assert len(terms) == 100_000
    got = {r["d"]: r["v"] for r in out.collect()}
    assert len(got) == 102 and {v.size for v in got.values()} == {100_000}
    assert [len(got[i].indices) for i in (0, 57, 100, 101)] == [1_000, 1_000, 0, 0]
    assert got[3].indices[0] == 3_000 and abs(got[3].values[0] - 1_000 ** -0.5) < 1e-12
    from tabula.operators import models
    one = models.assemble(out, ["v", "d"]).where("d = 5").first()["features"]
    assert one.size == 100_001 and one.numNonzeros() == 1_001


def test_tfidf_vectors_hold_the_same_weights(spark):
    df = spark.createDataFrame(DOCS, "d long, t string")
    out, terms = tfidf_vectors(df, "d", "t", 10, "v", bigrams=False)
    assert terms == ["apple", "green", "red"]
    got = {(r["d"], terms[i]): w for r in out.collect() for i, w in enumerate(r["v"].toArray()) if w}
    assert got == pytest.approx(brute_tfidf(DOCS))
    assert out.count() == len(DOCS)


def test_vocabulary_order_and_max_df(spark):
    df = spark.createDataFrame(DOCS, "d long, t string")
    frequency = document_frequency(term_counts(df, "d", "t"), "d")
    assert [r["term"] for r in vocabulary(frequency, F.lit(4), 2).collect()] == ["red", "apple"]
    assert [r["term"] for r in vocabulary(frequency, F.lit(4), 5, max_df=0.25).collect()] == ["green"]


# ---- splits

@pytest.mark.parametrize("digits, large", [(4, False), (1, False), (1, True)])
def test_split_takes_exact_shares(spark, monkeypatch, digits, large):
    if large:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    rows = [(i, 0 if i % 10 else 1) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y int")
    marked = split.stratified_split(df.repartition(5), "id", "y", 0.3, digits=digits)
    assert {(r["y"], r["is_test"]): r["count"] for r in marked.groupBy("y", "is_test").count().collect()} == {
        (0, 0): 315, (0, 1): 135, (1, 0): 35, (1, 1): 15}
    again = split.stratified_split(df.coalesce(1), "id", "y", 0.3, digits=digits)
    chosen = lambda d: sorted(r["id"] for r in d.where("is_test = 1").collect())
    assert chosen(marked) == chosen(again)
    assert marked.columns == ["id", "y", "is_test"] or set(marked.columns) == {"id", "y", "is_test"}


def test_split_with_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, y int")
    marked = split.stratified_split(df, "id", "y", 0.2)
    assert marked.where("is_test = 1").count() == 0 and marked.count() == 3


def test_folds_partition_the_rows(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "id long, y int")
    folds = split.stratified_folds(df, "id", "y", 5)
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    assert len(sizes) == 15 and max(sizes.values()) - min(sizes.values()) <= 1
    assert folds.select("id").distinct().count() == 200


def test_weights(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 1), (1, 2)], "y int, g int")
    got = {r["y"]: r["weight"] for r in split.balanced_weights(df, "y").collect()}
    assert got == pytest.approx({0: 5 / 6, 1: 5 / 4})
    weighted = split.positive_weights(df, "y", F.col("g") == 2)
    assert sorted((r["y"], r["g"], r["weight"]) for r in weighted.collect()) == [
        (0, 1, 1.0), (0, 1, 1.0), (0, 2, 1.0), (1, 1, 1.0), (1, 2, 1.0)]
