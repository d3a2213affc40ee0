import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabula.catalog import modelling
from tabula.catalog.registry import Tables
from tabula.operators import models
from tabula.operators.models import LABEL
from tabula.plans import cleaning, ensemble, laps, reports, tasks

SMALL = "/root/testdata/sf0.001"


def test_vulnerability_cleaning(spark):
    columns = ("cveID, vendorProject, product, vulnerabilityName, shortDescription, dateAdded, dueDate, "
               "knownRansomwareCampaignUse, cwes").split(", ")
    rows = [("CVE-2021-1 ", "v", "Unknown", "n", "d", "2024-01-01", "2024-01-20", "Known", '"CWE-1, CWE-2"', 1),
            ("CVE-2021-1", "late copy", "p", "n", "d", "2024-01-01", "bad", "Unknown", "", 2),
            ("odd", "v", "p", "n", "d", None, None, "Unknown", None, 3)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns) + ", seq int")
    got = {r["seq"]: r for r in cleaning.clean_vulnerabilities(raw, ["seq"]).collect()}
    assert set(got) == {1, 3}
    assert got[1]["CVE_Year"] == 2021 and got[1]["cwes_list"] == ["CWE-1", "CWE-2"] and got[1]["product"] is None
    assert got[1]["knownRansomwareCampaignUse"] is True and got[3]["knownRansomwareCampaignUse"] is None
    assert got[1]["dueDate"] == dt.datetime(2024, 1, 20) and got[3]["CVE_Year"] is None


def test_response_window_is_half_open(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base, base + dt.timedelta(days=d)) for d in (-1, 0, 14, 15, 59, 60)] + [(base, None)]
    df = spark.createDataFrame(rows, "dateAdded timestamp, dueDate timestamp")
    assert sorted(r["days"] for r in reports.response_window(df).collect()) == [0, 14, 15, 59]


def test_countries_count_list_items_not_characters(spark):
    df = spark.createDataFrame([(["France", "Peru"],), (["Peru"],)], "Countries_Clean array<string>")
    got = [tuple(r) for r in reports.top_list_items(df, "Countries_Clean", 5).collect()]
    assert got == [("Peru", 2.0), ("France", 1.0)]


def test_lap_features_shape_and_training_fit(spark):
    laps_table = Tables(spark, SMALL).derived("laps").withColumnRenamed("LapTime", laps.LAP_TIME)
    out = laps.lap_features(laps_table)
    assert out.count() == laps_table.count()
    assert not set(laps.TEXT_COLUMNS) & set(out.columns)
    assert len(out.columns) == 53
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("InMemoryRelation")[0]


def test_union_keeps_the_missing_target_null(spark):
    train = spark.createDataFrame([(1, 1)], "id int, y int")
    test = spark.createDataFrame([(2,)], "id int")
    both = laps.union_with_marker(train, test)
    first, second = laps.split_back(both)
    assert [tuple(r) for r in first.collect()] == [(1, 1)]
    assert [tuple(r) for r in second.collect()] == [(2, None)]


# ---- models

@pytest.fixture(scope="module")
def planted(spark):
    """Label follows x with some noise."""
    rows = spark.range(600).select(
        F.col("id"), (F.rand(7) * 10).alias("x"), F.rand(8).alias("noise"))
    labelled = rows.withColumn(LABEL, ((F.col("x") + F.col("noise") * 4) > 7).cast("int"))
    return models.assemble(labelled, ["x", "noise"]).withColumn("weight", F.lit(1.0)).select(
        "id", LABEL, "features", "weight").cache()


def test_feature_names_come_from_the_vector(spark):
    df = models.assemble(spark.createDataFrame([(1.0, None)], "a double, b double"), ["a", "b"])
    assert models.feature_names(df) == ["a", "b"]
    assert list(df.first()["features"].toArray()) == [1.0, 0.0]


def test_out_of_fold_scores_every_row_once(spark, planted):
    test = planted.where("id < 40").select("id", "features")
    oof, scored, fitted = models.out_of_fold(
        planted, test, lambda mark: {"lr": models.logistic(600), "gbt": models.boosted(4, 2, validation=mark)},
        "id", folds=3, early_stop=True)
    assert oof.count() == oof.select("id").distinct().count() == 600
    assert scored.count() == 40 and len(fitted) == 3
    assert oof.where("lr < 0 or lr > 1 or gbt < 0 or gbt > 1").count() == 0
    compared = {r["model"]: r for r in ensemble.metrics.compare_candidates(oof, LABEL, ["lr", "gbt"]).collect()}
    assert compared["lr"]["auc"] > 0.9 and compared["gbt"]["auc"] > 0.8
    stacked, _ = models.stack(oof, scored, ["lr", "gbt"], "id", 600)
    area = ensemble.metrics.auc(stacked, LABEL, "stacked").first()[0]
    assert area > 0.9 and stacked.count() == 600


def test_comparison_equals_recomputed_metrics(spark, planted):
    train, test = planted.where("id % 3 > 0"), planted.where("id % 3 = 0")
    scored, fitted = models.fit_and_score(
        train, test, {"lr": models.logistic(400), "rf": models.forest(5, 3)}, "id")
    table = {r["model"]: r for r in models.model_metrics(scored, 2).collect()}
    for name in fitted:
        rows = scored.where(F.col("model") == name).collect()
        right = sum(r["label"] == r["prediction"] for r in rows) / len(rows)
        assert table[name]["accuracy"] == pytest.approx(right) and 0.5 < table[name]["roc_auc"] <= 1
    top = models.top_importances(models.importances(spark, fitted["rf"], ["x", "noise"]), 1)
    assert top.first()["feature"] == "x"


def test_importances_are_scaled_before_the_mean(spark):
    a = spark.createDataFrame([("x", 300.0), ("y", 100.0), ("z", 0.0)], "feature string, importance double")
    b = spark.createDataFrame([("x", 0.1), ("y", 0.9)], "feature string, importance double")
    got = [(r["feature"], round(r["average"], 6)) for r in models.merge_importances({"a": a, "b": b}).collect()]
    assert got == [("y", 0.575), ("x", 0.425)]
    raw = models.merge_importances({"a": a, "b": b}, normalise=False).first()
    assert raw["feature"] == "x" and raw["average"] == pytest.approx(150.05)


def test_severity_task_leaves_other_levels_out(spark):
    t = Tables(spark, SMALL)
    result = tasks.ip_severity(t.ips(), rounds=2, trees=3)
    levels = t.ips().where(F.col("Threat_Severity").isin(tasks.LEVELS)).count()
    rows = result.predictions("Random Forest").count()
    assert abs(rows - 0.3 * levels) <= 2
    assert {r["model"] for r in result.comparison.collect()} == set(result.fitted)
    assert result.confusion("Random Forest").agg(F.sum("n")).first()[0] == rows
    assert result.report("Random Forest").where("label = 'accuracy'").count() == 1
    assert result.importances("Random Forest", 15).count() == 15
    assert tasks.summary([result]).first()["task"] == "ip severity"


def test_text_task_runs_on_training_vocabulary(spark):
    t = Tables(spark, SMALL)
    result = tasks.ransomware(t.vulnerabilities().limit(600), ["the"], rounds=2, trees=3)
    assert result.comparison.count() == 5
    assert result.names[-2:] == ["CVE_Year", "Vendor_Encoded"] and len(result.names) <= 502
    assert result.roc("Random Forest").where("fpr = 0 and tpr = 0").count() >= 1


def test_ensemble_tables(spark):
    table = Tables(spark, SMALL).derived("laps").withColumnRenamed("LapTime", laps.LAP_TIME)
    rows = reports_stored(laps.lap_features(table))
    train, test = rows.where("Stint < 3"), rows.where("Stint = 3").drop(laps.TARGET)
    fitted = ensemble.fit_ensemble(
        train, test, lambda mark: {"a": models.boosted(3, 3, weighted=True, validation=mark),
                                   "b": models.boosted(3, 2, weighted=True, validation=mark)}, folds=3)
    assert fitted.oof.count() == train.count() and fitted.test.count() == test.count()
    compared = {r["model"]: r for r in fitted.comparison().collect()}
    assert set(compared) == {"a", "b", "average", "stacked"}
    out = fitted.submission(test.select("id"), "id")
    assert out.columns == ["id", laps.TARGET, f"{laps.TARGET}_prob"] and out.count() == test.count()
    assert fitted.report().where("label = 'macro avg'").count() == 1
    assert fitted.importances(5).count() == 5


def reports_stored(df):
    from tabula.operators.sizing import stored
    return stored(df, "laps-test")


def test_kpis_are_computed(spark):
    t = Tables(spark, SMALL)
    scores = spark.createDataFrame([("A", 0.5), ("B", 0.671)], "model string, f1_macro double")
    got = {r["kpi"]: r["value"] for r in reports.kpi_matrix(
        t.pulses(), t.vulnerabilities(), t.domains(), t.ips(), scores).collect()}
    assert got["ransomware_model_f1"] == "0.67 (B)"
    total = sum(x.count() for x in (t.pulses(), t.vulnerabilities(), t.domains(), t.ips()))
    assert got["rows_total"] == str(total)


def test_registered_models_take_the_full_numbers(spark, monkeypatch):
    seen = {}

    class Reached(Exception):
        pass

    def reach(*args, **named):
        seen["args"], seen["named"] = args, named
        raise Reached

    def size(m):
        if isinstance(m, models.Booster):
            return m.rounds, m.depth
        return m.getNumTrees() if m.hasParam("numTrees") else m.getMaxIter(), m.getMaxDepth()

    monkeypatch.setattr(modelling, "_lap_task", lambda t, make: make(spark.range(5)))
    assert size(modelling.rf_fit(None)["Random Forest"]) == (100, 10)
    assert size(modelling.gbt_fit(None)["Gradient Boosting"]) == (100, 3)
    assert {(m.rounds, m.depth, m.patience) for m in models.boosting_variants().values()} == {(2000, 8, 100)}
    compared = modelling.model_compare(None)
    assert size(compared["Random Forest"]) == (100, 10) and size(compared["Gradient Boosting"]) == (100, 3)

    monkeypatch.setattr(modelling, "_weighted_laps", lambda t: (spark.range(5).withColumn("features", F.lit(1)), []))
    monkeypatch.setattr(modelling.models, "out_of_fold", reach)
    with pytest.raises(Reached):
        modelling.oof_predictions(None)
    assert {size(m) for m in seen["args"][2]("_stop").values()} == {(2000, 8)} and seen["named"].get("folds", 5) == 5

    monkeypatch.setattr(modelling, "fit_ensemble", reach)
    with pytest.raises(Reached):
        modelling._ensemble(Tables(spark, SMALL))
    made = seen["args"][2]("_stop")
    assert len(made) == 3 and {size(m) for m in made.values()} == {(2000, 8)} and "folds" not in seen["named"]

    for name in ("ransomware", "industry", "domain_severity", "ip_severity"):
        monkeypatch.setattr(modelling.tasks, name, reach)
        with pytest.raises(Reached):
            getattr(modelling, f"task_{name}")(Tables(spark, SMALL))
        assert not {"rounds", "trees"} & set(seen["named"])

    monkeypatch.setattr(modelling.models.RandomForestClassifier, "fit", lambda self, rows: reach(size(self)))
    with pytest.raises(Reached):
        modelling.feature_importance(None)
    assert seen["args"][0] == (100, 10)


def test_industry_and_ip_tasks_have_a_weighted_booster(spark, monkeypatch):
    monkeypatch.setattr(tasks, "_run", lambda *args: args[-1])
    t = Tables(spark, SMALL)
    for made in (tasks.ip_severity(t.ips()), tasks.industry(t.pulses(), ["the"])):
        assert made["Weighted Boosting"].weighted and not made["Boosting"].weighted
    assert "Weighted Boosting" not in tasks.domain_severity(t.domains())


def test_weighted_booster_follows_the_weights(spark):
    rows = spark.range(400).select("id", (F.col("id") % 8 == 0).cast("int").alias(LABEL), F.lit(1.0).alias("x"))
    rows = models.assemble(rows.withColumn("weight", F.when(F.col(LABEL) == 1, 20.0).otherwise(1.0)), ["x"])
    for weighted, wanted in ((False, 0), (True, 1)):
        fitted = models.boosted_multiclass(2, 1, 1, weighted=weighted).fit(rows)
        assert fitted.transform(rows).first()["prediction"] == wanted


def test_laps_are_written_as_columns_not_as_vectors(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1, 2023, 2.0, None), ("b", None, None, 0.0, 3)], f"id string, {laps.TARGET} int, Year int, x double, y int")
    written, store = [], ensemble.stored
    small, _ = ensemble.lap_vectors(rows)
    monkeypatch.setattr(ensemble, "LARGE_LAPS", 1)
    monkeypatch.setattr(ensemble, "stored", lambda df, name: written.append(df.columns) or store(df, name))
    table, names = ensemble.lap_vectors(rows)
    assert names == ["Year", "x", "y"] and written == [["id", LABEL, "Year", "x", "y"]]
    assert table.columns == ["id", LABEL, "features", "Year"] and models.feature_names(table) == names
    got = {r["id"]: (r[LABEL], r["features"].toArray().tolist(), r["Year"]) for r in table.collect()}
    assert got == {"a": (1, [2023.0, 2.0, 0.0], 2023.0), "b": (None, [0.0, 0.0, 3.0], 0.0)}
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, table.collect()))


def test_fits_on_large_tables_take_turns_and_keep_no_second_copy(spark, planted, monkeypatch):
    import time

    from pyspark import StorageLevel

    running, seen = [], []

    class Slow:
        def fit(self, rows):
            running.append(1)
            seen.append((len(running), rows.storageLevel))
            time.sleep(0.3)
            running.pop()

    rows = planted.where("id >= 0")
    monkeypatch.setattr(models, "score_all", lambda *args: None)
    assert models._vector_bytes(rows) == 600 * 2 * 8
    for large in (1 << 30, 0):
        monkeypatch.setattr(models, "LARGE_BYTES", large)
        models.fit_and_score(rows, rows, {"a": Slow(), "b": Slow()}, "id")
    assert max(n for n, _ in seen[:2]) == 2 and max(n for n, _ in seen[2:]) == 1
    assert all(level == StorageLevel.NONE for _, level in seen)
