import datetime as dt

from pyspark.sql import functions as F

from tabula.operators import timeline
from tabula.operators.sizing import shared_folder
from tabula.sources.tables import read_table
from tabula.streaming import incremental

SMALL = "/root/testdata/sf0.001"


def test_daily_counts_agree_with_batch_up_to_the_watermark(spark):
    source = shared_folder(spark, "arrivals")
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(source)
    rows = incremental.read_arrivals(spark, source, events.schema)
    out, state = shared_folder(spark, "daily"), shared_folder(spark, "daily-state")
    incremental.append_available(incremental.daily_counts(rows, "ts"), out, state).awaitTermination(120)
    got = {r["day"]: r["n"] for r in spark.read.parquet(out).collect()}
    want = {r["period"]: r["n"] for r in timeline.daily_counts(read_table(spark, SMALL, "events"), "ts").collect()}
    last = max(want)
    assert got == {d: n for d, n in want.items() if d < last - dt.timedelta(days=1) or d in got}
    assert len(got) >= len(want) - 2


def test_first_seen_drops_copies(spark):
    source = shared_folder(spark, "copies")
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", base), ("a", base), ("b", base)], "k string, t timestamp").write.parquet(source)
    rows = incremental.read_arrivals(spark, source, spark.read.parquet(source).schema)
    out, state = shared_folder(spark, "first"), shared_folder(spark, "first-state")
    incremental.append_available(incremental.first_seen(rows, ["k"], "t"), out, state).awaitTermination(120)
    assert sorted(r["k"] for r in spark.read.parquet(out).select(F.col("k")).collect()) == ["a", "b"]
