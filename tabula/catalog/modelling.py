"""Model jobs on whole tables. Fits are iterative, so these have no SQL; the metrics they report come
from the aggregates that are checked on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.catalog.features import STOP_WORDS, laps_of
from tabula.catalog.registry import Tables, query
from tabula.operators import models
from tabula.operators.models import LABEL, WEIGHT
from tabula.operators.sizing import stored
from tabula.operators.split import balanced_weights, positive_weights, stratified_folds, stratified_split
from tabula.plans import tasks
from tabula.plans.ensemble import FOLDS, LARGE_LAPS, Ensemble, fit_ensemble, lap_vectors
from tabula.plans.laps import ODD_YEAR, lap_features, split_back, union_with_marker


def _lap_vectors(t: Tables) -> tuple[DataFrame, list[str]]:
    laps = laps_of(t)
    return lap_vectors(lap_features(laps), rows=laps.count())


def _lap_split(t: Tables) -> DataFrame:
    """Lap vectors with a holdout mark. It follows from the id; of many laps it is found again with every read."""
    laps = laps_of(t)
    rows = laps.count()
    table, _ = lap_vectors(lap_features(laps), rows=rows)
    split = stratified_split(table, "id", LABEL, 0.2)
    return split if rows > LARGE_LAPS else stored(split, "split")


def _lap_task(t: Tables, candidates) -> DataFrame:
    """Holdout metrics of candidates on the lap features with balanced weights."""
    split = _lap_split(t)
    train = balanced_weights(split.where(F.col("is_test") == 0), LABEL, WEIGHT)
    scored, _ = models.fit_and_score(train, split.where(F.col("is_test") == 1), candidates(train), "id")
    return models.model_metrics(scored, 2)


@query("lr_fit")
def lr_fit(t: Tables):
    return _lap_task(t, lambda train: {"Logistic Regression": models.logistic(train.count(), max_iter=2000)})


@query("rf_fit")
def rf_fit(t: Tables):
    return _lap_task(t, lambda train: {"Random Forest": models.forest()})


@query("gbt_fit")
def gbt_fit(t: Tables):
    return _lap_task(t, lambda train: {"Gradient Boosting": models.boosted()})


@query("gbt_variants")
def gbt_variants(t: Tables):
    """Three boosters; a fifth of the training rows stops their rounds."""
    split = _lap_split(t)
    train = stratified_folds(balanced_weights(split.where(F.col("is_test") == 0), LABEL, WEIGHT), "id", LABEL, FOLDS)
    fitted = models.fit_all(stored(train, "stops"), "fold", [models.Fit(b, stop=0) for b in models.boosting_variants().values()])
    scored = models.score_all(split.where(F.col("is_test") == 1), dict(zip(models.boosting_variants(), fitted)), "id")
    return models.model_metrics(scored, 2)


@query("model_compare")
def model_compare(t: Tables):
    return _lap_task(t, lambda train: {
        "Logistic Regression": models.logistic(train.count(), max_iter=2000), "Random Forest": models.forest(),
        "Gradient Boosting": models.boosted()})


def _weighted_laps(t: Tables) -> tuple[DataFrame, list[str]]:
    table, names = _lap_vectors(t)
    return positive_weights(table, LABEL, F.col("Year") == ODD_YEAR, name=WEIGHT).drop("Year"), names


@query("oof_predictions")
def oof_predictions(t: Tables):
    """(id, label, fold, booster): every lap scored by a model that has not seen it."""
    rows, _ = _weighted_laps(t)
    oof, _, _ = models.out_of_fold(
        rows, rows.select("id", "features"),
        lambda mark: {"booster": models.boosting_variants(validation=mark)["leafwise"]}, "id", early_stop=True)
    return oof


@query("feature_importance")
def feature_importance(t: Tables):
    rows, names = _weighted_laps(t)
    fitted = models.forest().fit(rows)
    return models.top_importances(models.importances(t.spark, fitted, names), 20)


def _ensemble(t: Tables) -> Ensemble:
    """Laps of the last stint play the unlabelled test table."""
    laps = laps_of(t)
    train, test = laps.where(F.col("Stint") < 3), laps.where(F.col("Stint") == 3).drop("PitNextLap")
    rows = stored(lap_features(union_with_marker(train, test)), "lap-features")
    train_features, test_features = split_back(rows)
    return fit_ensemble(train_features, test_features,
                        lambda mark: models.boosting_variants(validation=mark))


@query("stacking")
def stacking(t: Tables):
    """AUC, best threshold and F1 of each candidate, their average and the stacked model."""
    return _ensemble(t).comparison()


@query("ensemble_submission")
def ensemble_submission(t: Tables):
    ensemble = _ensemble(t)
    template = ensemble.test.select("id")
    return ensemble.submission(template, "id").join(ensemble.probabilities("id"), "id")


@query("task_ransomware")
def task_ransomware(t: Tables):
    return tasks.ransomware(stored(t.vulnerabilities(), "vulnerabilities"), STOP_WORDS).comparison


@query("task_industry")
def task_industry(t: Tables):
    return tasks.industry(stored(t.pulses(), "pulses"), STOP_WORDS).comparison


@query("task_domain_severity")
def task_domain_severity(t: Tables):
    return tasks.domain_severity(stored(t.domains(), "domains")).comparison


@query("task_ip_severity")
def task_ip_severity(t: Tables):
    result = tasks.ip_severity(stored(t.ips(), "ips"))
    return result.comparison.unionByName(tasks.summary([result]).select(
        F.concat(F.lit("best: "), "best_model").alias("model"), F.lit(None).cast("double").alias("accuracy"),
        F.col("score").alias("f1_macro"), F.lit(None).cast("double").alias("f1_weighted"),
        F.lit(None).cast("double").alias("roc_auc")))
