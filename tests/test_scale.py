"""Plans that must hold when one key has a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tabula.operators import groupwise, sizing


@pytest.fixture
def no_small_sides(spark, monkeypatch):
    """Lookups count as large, Spark broadcasts nothing unasked, and partitions count as skewed early."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def hot_rows(spark):
    """Key 7 has a third of the rows, a missing key a tenth."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 10 == 1, F.lit(None)).otherwise(n % 5000)
    return spark.range(0, 90_000, numPartitions=12).select(
        "id", key.cast("long").alias("k"), F.md5(n.cast("string")).alias("payload"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_hot_key_of_a_large_lookup_is_split(spark, no_small_sides, how):
    rows = hot_rows(spark)
    lookup = rows.dropna().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = sizing.attach(rows, lookup, "k", how)
    got = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert len(got) == (90_000 if how == "left" else rows.dropna().count())
    if how != "left_semi":
        assert {r["n"] for r in got if r["k"] == 7} == {sum(r["k"] == 7 for r in got)}
        assert all(r["n"] is None for r in got if r["k"] is None)


def test_group_statistics_never_window_raw_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    for out in (groupwise.is_last(rows, ["g"], "x", "l"), groupwise.remaining(rows, ["g"], "x", "r"),
                groupwise.ratio_and_zscore(rows, "g", "x", "q", "z")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "BroadcastHashJoin" in plan


def test_missing_keys_keep_their_sums_in_slices(spark):
    from tabula.operators.sizing import running_sums

    cells = spark.createDataFrame(
        [(g, float(v), 1 + v % 3) for g in ("a", None) for v in range(40)], "g string, v double, n long")
    whole = running_sums(cells, ["g"], "v", {"n": "upto"}, {"n": "total"})
    sliced = running_sums(cells, ["g"], "v", {"n": "upto"}, {"n": "total"}, window_rows=5)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, sliced.collect()), key=repr)


def test_large_nested_lookups_shuffle_the_rows_once(spark, no_small_sides):
    n = F.col("id")
    some = lambda every, value: F.when(n % every == 0, F.lit(None)).otherwise(value)
    rows = spark.range(0, 3_000, numPartitions=4).select(
        "id", some(11, n % 50).alias("a"), some(13, n % 4).alias("b"), some(17, n % 7).cast("string").alias("c d"), F.lit(None).cast("int").alias("e"))
    lookups = [(groupwise.group_stats(rows, keys, {f"n{i}": F.count(F.lit(1)), f"top{i}": F.max("id")}), keys)
               for i, keys in enumerate((["a", "b", "c d"], ["a", "b"], ["a"], ["e"]))]
    nested = sizing.attach_all(rows, rows, lookups[:3])
    one_by_one = rows
    for lookup, keys in lookups[:3]:
        one_by_one = sizing.attach(one_by_one, lookup, keys)
    assert nested.columns == [*rows.columns, "n0", "top0", "n1", "top1", "n2", "top2"]
    assert sorted(map(tuple, nested.collect()), key=repr) == sorted(map(tuple, one_by_one.select(nested.columns).collect()), key=repr)
    plan = nested._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin") == 1
    assert sizing.attach_all(rows, rows, lookups[3:]).where("n3 is not null").count() == 0


def test_lap_statistics_of_races_are_joined_at_once(spark, no_small_sides):
    from tabula.plans import laps

    n = F.col("id")
    rows = spark.range(600).select(
        n.cast("string").alias("id"), F.when(n % 3 > 0, "ABC").alias("Driver"), F.concat(F.lit("race "), n % 40).alias("Race"), F.lit("SOFT").alias("Compound"),
        (2022 + n % 2).cast("int").alias("Year"), *[(n % 9).cast("int").alias(c) for c in ("LapNumber", "Stint", "Position", "Position_Change")],
        *[(n % 30).cast("double").alias(c) for c in ("TyreLife", laps.LAP_TIME, "Cumulative_Degradation", "RaceProgress")], F.lit(1).alias(laps.TARGET))
    out = laps.lap_features(rows)
    found = {r["id"]: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # compound, rank, driver code, and one for race, year and driver
    assert plan.count("SortMergeJoin") <= 4
    assert len(found) == 600 and found["1"]["Race_Avg_LapTime"] is not None


def test_laps_are_read_from_the_given_file(spark):
    from tabula.catalog.features import laps_of
    from tabula.catalog.registry import Tables

    assert all(f.endswith("lineitem.parquet") for f in laps_of(Tables(spark, "/root/testdata/sf0.001")).inputFiles())
