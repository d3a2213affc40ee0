from pyspark.sql import functions as F

from tabula.functions.cleaning import NA_TOKENS, NA_TOKENS_COMPAT
from tabula.operators.sizing import pinned, shared_folder, stored
from tabula.sources import delimited, tables


def written(spark, text, name):
    path = shared_folder(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_ragged_and_multiline_rows(spark):
    text = 'a,b,c\n1,"x, ""y""\nnext line",3\n2,short\n3,too,long,row,"with, comma"\n4,,ok'
    path = written(spark, text, "ragged")
    rows = delimited.read_csv(spark, path, ["a", "b", "c"])
    assert sorted(map(tuple, rows.collect())) == [
        ("1", 'x, "y"\nnext line', "3"), ("2", "short", None), ("4", None, "ok")]
    bad = delimited.overlong_rows(spark, path, ["a", "b", "c"])
    assert [r["raw"] for r in bad.collect()] == ['3,too,long,row,"with, comma"']


def test_na_presets(spark):
    df = spark.createDataFrame([("NA", 1), ("N/A", 2), ("EU", 3), (None, 4)], "c string, n int")
    plain = [r["c"] for r in delimited.with_na(df, NA_TOKENS).orderBy("n").collect()]
    compatible = [r["c"] for r in delimited.with_na(df, NA_TOKENS_COMPAT).orderBy("n").collect()]
    assert plain == ["NA", None, "EU", None] and compatible == [None, None, "EU", None]


def test_csv_round_trip_keeps_arrays_and_quotes(spark):
    df = spark.createDataFrame([("1", 'say "hi", you', ["a", "b c"]), ("2", None, [])],
                               "id string, t string, x array<string>")
    path = shared_folder(spark, "trip")
    delimited.write_csv(df, path)
    back = delimited.with_lists(delimited.read_csv(spark, path, df.columns, multiline=False), ["x"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_metrics_are_pruned_to_their_task(spark):
    df = spark.createDataFrame([("m", 0.5, "a"), ("n", 0.7, "b")], "model string, f1 double, task string")
    path = shared_folder(spark, "metrics")
    delimited.write_table(df, path, ["task"])
    one = tables.metrics_of(spark.read.parquet(path), "b")
    assert [tuple(r) for r in one.collect()] == [("n", 0.7, "b")]
    assert "PartitionFilters: [isnotnull(task" in one._jdf.queryExecution().executedPlan().toString()
    assert tables.metrics_of(spark.read.parquet(path), "none").count() == 0


def test_submission_matches_by_id(spark):
    template = spark.createDataFrame([(2,), (1,), (3,)], "id long")
    scores = spark.createDataFrame([(1, 0.9), (2, 0.4)], "id long, s double")
    out = tables.submission(template, scores, "id", "s", 0.4, "y")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 0.9), (2, 0, 0.4), (3, 0, None)]


def test_times_without_zone_become_timestamps_and_tables_spread_only_when_asked(spark):
    df = tables.read_table(spark, "/root/testdata/sf0.001", "events")
    assert dict(df.dtypes)["ts"] == "timestamp"
    assert "Repartition" not in df._jdf.queryExecution().analyzed().toString()
    assert tables.read_table(spark, "/root/testdata/sf0.001", "events", parts=3).rdd.getNumPartitions() == 3


def test_stored_and_pinned_cut_the_plan(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    for kept in (stored(df, "cut"), pinned(df)):
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))
        assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
