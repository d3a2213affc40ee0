import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabula.operators import metrics, sizing


def scored(spark, rows):
    return spark.createDataFrame([(float(s), int(y)) for s, y in rows], "s double, y int")


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_counts_ties_half(spark):
    assert metrics.auc(scored(spark, [(.1, 0), (.4, 0), (.4, 1), (.8, 1)]), "y", "s").first()[0] == 0.875


def test_auc_of_one_class_is_missing(spark):
    assert metrics.auc(scored(spark, [(.1, 0), (.4, 0)]), "y", "s").first()[0] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_auc_matches_pairs(spark, rows):
    got = metrics.auc(scored(spark, rows), "y", "s").first()
    want = brute_auc(rows)
    assert (got[0] if got else None) == (pytest.approx(want) if want is not None else None)


def test_auc_mirrors_and_slices(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.random(), rng.randrange(2)) for _ in range(300)]
    df = scored(spark, rows).repartition(4)
    area = metrics.auc(df, "y", "s").first()[0]
    mirrored = metrics.auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first()[0]
    assert area == pytest.approx(brute_auc(rows)) and mirrored == pytest.approx(1 - area)
    monkeypatch.setattr(sizing, "WINDOW_ROWS", 32)
    assert metrics.auc(df, "y", "s").first()[0] == pytest.approx(area)


def test_one_vs_rest_needs_every_class(spark):
    rows = [(0, [.9, .1, 0.]), (1, [.2, .7, .1]), (1, [.5, .4, .1])]
    df = spark.createDataFrame(rows, "y int, p array<double>")
    assert metrics.auc_one_vs_rest(df, "y", "p").first()[0] is None
    whole = spark.createDataFrame(rows + [(2, [.1, .1, .8])], "y int, p array<double>")
    assert metrics.auc_one_vs_rest(whole, "y", "p").first()[0] == pytest.approx(1.0)


def test_roc_curve_starts_at_origin_and_ends_at_one(spark):
    rows = metrics.roc_curve(scored(spark, [(.1, 0), (.4, 1), (.4, 0), (.8, 1)]), "y", "s").collect()
    points = sorted((r["fpr"], r["tpr"]) for r in rows)
    assert points == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(0.875)


def test_grids():
    assert metrics.COARSE_GRID[0] == 0.1 and metrics.COARSE_GRID[-1] == 0.58 and len(metrics.COARSE_GRID) == 25
    assert metrics.FINE_GRID[0] == 0.2 and metrics.FINE_GRID[-1] == 0.54 and len(metrics.FINE_GRID) == 35


def test_first_best_threshold_wins(spark):
    row = metrics.best_threshold(scored(spark, [(.05, 0), (.3, 1), (.3, 1)]), "y", "s").first()
    assert (row["best_threshold"], row["best_f1"]) == (0.1, 1.0)


def test_threshold_default_when_nothing_scores(spark):
    row = metrics.best_threshold(scored(spark, [(.05, 1), (.3, 0)]), "y", "s").first()
    assert (row["best_threshold"], row["best_f1"]) == (0.5, 0.0)


def test_sweep_matches_direct_f1(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 2), rng.randrange(2)) for _ in range(80)]
    got = {r["threshold"]: r["f1"] for r in metrics.threshold_sweep(scored(spark, rows), "y", "s").collect()}
    for t in metrics.COARSE_GRID:
        tp = sum(s > t and y == 1 for s, y in rows)
        said, real = sum(s > t for s, _ in rows), sum(y for _, y in rows)
        assert got[t] == pytest.approx(2 * tp / (said + real) if said + real else 0.0)


def test_f1_and_report_with_a_silent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    row = metrics.f1_scores(df, "y", "p").first()
    per = [2 / 3, 0.5, 0.0]
    assert row["f1_macro"] == pytest.approx(sum(per) / 3)
    assert row["f1_weighted"] == pytest.approx((2 * per[0] + per[1] + per[2]) / 4)
    report = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert set(report) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == 0.5 and report["2"]["precision"] == 0.0


def test_confusion_matrix_has_every_cell(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "c")], "y string, p string")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert len(cells) == 9 and cells["b", "c"] == 1 and cells["c", "c"] == 0
    assert metrics.confusion_matrix(df, "y", "p", first=2).count() == 4


def test_best_model_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("t", "b", .5), ("t", "a", .5), ("u", "c", None), ("u", "d", .1)],
                               "task string, model string, f1 double")
    assert metrics.best_model(df, "f1").first()["model"] == "a"
    assert {r["task"]: r["model"] for r in metrics.best_model(df, "f1", ["task"]).collect()} == {"t": "a", "u": "d"}
