"""Distributed model jobs: candidates, comparison, out-of-fold scores, stacking, importances.

Scores of several models are put next to each other by chaining ``transform`` on the same row, so no
prediction is ever joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions.numeric import row_mean
from tabula.operators import metrics
from tabula.operators.boosting import Booster, BoosterModel, Fit, add_scores, fit_all
from tabula.operators.sizing import stored
from tabula.operators.split import stratified_folds

FEATURES, LABEL, WEIGHT = "features", "label", "weight"
SEED = 42
#: Fits of the library's own models that run as jobs at the same time, and bytes of vectors past which they run one
#: after another: each keeps a copy of the rows in its own form until it is done.
CONCURRENT = 4
LARGE_BYTES = 256 << 20

Candidates = Mapping[str, Estimator | Booster]


# ---- candidates

def logistic(rows: int, c: float = 1.0, weighted: bool = True, max_iter: int = 100) -> LogisticRegression:
    """``c`` is the inverse penalty of the summed loss; balanced weights sum to the row count."""
    model = LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, regParam=1.0 / (c * max(rows, 1)),
        standardization=False, maxIter=max_iter)
    return model.setWeightCol(WEIGHT) if weighted else model


def forest(trees: int = 100, depth: int = 10, weighted: bool = True) -> RandomForestClassifier:
    model = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=SEED)
    return model.setWeightCol(WEIGHT) if weighted else model


def boosted(rounds: int = 100, depth: int = 3, rate: float = 0.1, subsample: float = 1.0,
            feature_share: str = "all", least_rows: int = 1, weighted: bool = False,
            validation: str | None = None) -> GBTClassifier:
    """Gradient-boosted trees for two classes; with ``validation`` the marked rows stop the rounds
    early and are not trained on."""
    model = GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=subsample, featureSubsetStrategy=feature_share, minInstancesPerNode=least_rows,
        seed=SEED)
    if weighted:
        model.setWeightCol(WEIGHT)
    if validation:
        # the default tolerance asks every round for a gain of a hundredth and keeps one tree at small rates
        model.setValidationIndicatorCol(validation).setParams(validationTol=0.0)
    return model


def boosted_multiclass(classes: int, rounds: int = 100, depth: int = 3, rate: float = 0.1,
                       weighted: bool = False) -> Booster:
    """One softmax model for all classes."""
    return Booster(rounds=rounds, depth=depth, rate=rate, classes=classes, weighted=weighted)


def boosting_variants(rounds: int = 2000, depth: int = 8, rate: float = 0.05, patience: int = 100,
                      validation: str | None = None) -> dict[str, Booster]:
    """Three differently regularised boosters for the ensemble: large leaves, leaves of some weight, and a
    strong penalty on leaves. ``patience`` rounds without a gain on the stopping rows end a fit."""
    shared = dict(rounds=rounds, depth=depth, rate=rate, row_share=0.8, column_share=0.7, weighted=True,
                  patience=patience, validation=validation)
    return {
        "leafwise": Booster(**shared, l1=0.1, l2=1.0, least_rows=50, least_hessian=1e-3),
        "depthwise": Booster(**shared, l1=0.1, l2=1.0, least_hessian=5.0),
        "symmetric": Booster(**shared, l2=3.0, least_hessian=0.0),
    }


# ---- vectors

def assemble(df: DataFrame, columns: Sequence[str], name: str = FEATURES) -> DataFrame:
    """Numeric and vector columns side by side as one vector; missing numbers are zero."""
    vectors = {f.name for f in df.schema.fields if f.dataType.typeName() in ("udt", "vectorudt")}
    numeric = [c for c in columns if c not in vectors]
    filled = df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in numeric})
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(filled)


def feature_names(df: DataFrame, column: str = FEATURES) -> list[str]:
    """Slot names as the assembler recorded them."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name for _, name in slots]


# ---- comparison

def _scored(model: Model | BoosterModel, rows: DataFrame, name: str, id_column: str) -> DataFrame:
    return model.transform(rows).select(
        F.lit(name).alias("model"), id_column, F.col(LABEL).cast("int").alias(LABEL),
        F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability").alias("scores"))


def _side_by_side(jobs: Sequence[Callable], most: int = CONCURRENT) -> list:
    """Results of independent Spark jobs, several at a time."""
    if min(most, len(jobs)) < 2:
        return [job() for job in jobs]
    with ThreadPool(min(most, len(jobs))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.getActiveSession())(lambda job: job()), jobs))


def _vector_bytes(rows: DataFrame) -> int:
    """Bytes of the numbers that the vectors of a table hold."""
    return 8 * int(rows.agg(F.sum(F.size(F.unwrap_udt(F.col(FEATURES))["values"]))).first()[0] or 0)


def _fit_candidates(train: DataFrame, candidates: Candidates) -> dict:
    """All candidates on the same rows: boosters in one job, the others as concurrent jobs."""
    plain = {n: c for n, c in candidates.items() if isinstance(c, Booster) and not c.validation}
    others = {n: c for n, c in candidates.items() if n not in plain}
    jobs = [lambda c=c: c.fit(train) for c in others.values()]
    if plain:
        jobs.append(lambda: fit_all(train.withColumn("_fold", F.lit(0)), "_fold", [Fit(c) for c in plain.values()]))
    made = _side_by_side(jobs, 1 if len(jobs) > 1 and _vector_bytes(train) > LARGE_BYTES else CONCURRENT)
    fitted = dict(zip(others, made)) | (dict(zip(plain, made[-1])) if plain else {})
    return {name: fitted[name] for name in candidates}


def fit_and_score(train: DataFrame, test: DataFrame, candidates: Candidates, id_column: str
                  ) -> tuple[DataFrame, dict[str, Model | BoosterModel]]:
    """Fit every candidate on the training vectors and score the test rows: (model, id, label, prediction, scores),
    stored because every metric reads it. The library's fits keep the rows in their own form, so they are not kept twice."""
    fitted = _fit_candidates(train, candidates)
    return score_all(test, fitted, id_column), fitted


def score_all(rows: DataFrame, fitted: Mapping[str, Model | BoosterModel], id_column: str) -> DataFrame:
    """(model, id, label, prediction, scores) of every model on the same rows, stored."""
    return stored(reduce(DataFrame.unionByName, [
        _scored(model, rows, name, id_column) for name, model in fitted.items()]), "scored")


def model_metrics(scored: DataFrame, classes: int) -> DataFrame:
    """(model, accuracy, f1_macro, f1_weighted, roc_auc) for a table of :func:`fit_and_score`."""
    right = metrics.accuracy(scored, LABEL, "prediction", ["model"])
    f1 = metrics.f1_scores(scored, LABEL, "prediction", ["model"]).drop("f1_binary")
    if classes == 2:
        area = metrics.auc(scored.withColumn("_score", F.col("scores")[1]), LABEL, "_score", ["model"])
    else:
        area = metrics.auc_one_vs_rest(scored, LABEL, "scores", ["model"])
    # one row per model on every side
    return right.join(f1, "model").join(area.withColumnRenamed("auc", "roc_auc"), "model", "left")


# ---- out-of-fold scores

def _with_scores(rows: DataFrame, fitted: Mapping[str, Model | BoosterModel]) -> DataFrame:
    boosters = {name: model for name, model in fitted.items() if isinstance(model, BoosterModel)}
    if boosters:
        rows = add_scores(rows, boosters)
    for name, model in fitted.items():
        if name in boosters:
            continue
        rows = (model.transform(rows).withColumn(name, vector_to_array("probability")[1])
                .drop("prediction", "probability", "rawPrediction"))
    return rows


def _fit_folds(dealt: DataFrame, candidates: Candidates, folds: int, mark: str | None) -> list[dict]:
    """Every candidate without each fold in turn, all fits side by side. The boosters bin the table once."""
    stop = {fold: (fold + 1) % folds if mark else None for fold in range(folds)}
    boosters = {n: c for n, c in candidates.items() if isinstance(c, Booster)}
    keys = [(fold, name) for name in candidates if name not in boosters for fold in range(folds)]
    own = [(fold, name) for name in boosters for fold in range(folds)]

    def rows(fold: int) -> DataFrame:
        kept = dealt.where(F.col("fold") != fold)
        return kept.withColumn(mark, F.col("fold") == stop[fold]) if mark else kept

    jobs = [lambda fold=fold, name=name: candidates[name].fit(rows(fold)) for fold, name in keys]
    if own:
        jobs.append(lambda: fit_all(dealt, "fold", [Fit(boosters[name], fold, stop[fold]) for fold, name in own]))
    made = _side_by_side(jobs)
    fitted = dict(zip(keys, made)) | (dict(zip(own, made[-1])) if own else {})
    return [{name: fitted[fold, name] for name in candidates} for fold in range(folds)]


def out_of_fold(train: DataFrame, test: DataFrame, make: Callable[[str | None], Candidates],
                id_column: str, folds: int = 5, early_stop: bool = False, seed: int = SEED, carry: Sequence[str] = ()
                ) -> tuple[DataFrame, DataFrame, list[dict[str, Model | BoosterModel]]]:
    """Fit the candidates ``folds`` times; score each row by the models that have not seen it.

    Returns (id, label, fold, ``carry`` columns, one score column per candidate), (id, ``carry`` columns, one mean
    score column per candidate) for the test rows, and the fitted models per fold. With ``early_stop`` the fold after
    the scored one stops the rounds, so the scored fold stays unseen.
    """
    if early_stop and folds < 3:
        raise ValueError("early stopping needs a third fold to train on")
    dealt = stored(stratified_folds(train, id_column, LABEL, folds, seed), "folds")
    mark = "_stop" if early_stop else None
    models = _fit_folds(dealt, make(mark), folds, mark)
    names = list(models[0])
    oof = reduce(DataFrame.unionByName, [
        _with_scores(dealt.where(F.col("fold") == fold), fitted) for fold, fitted in enumerate(models)]).select(
        id_column, LABEL, "fold", *carry, *names)
    scored = _with_scores(test, {f"{name}_{fold}": m for fold, fitted in enumerate(models) for name, m in fitted.items()})
    means = scored.select(id_column, *carry, *[
        row_mean(*[F.col(f"{name}_{fold}") for fold in range(folds)]).alias(name) for name in names])
    return stored(oof, "oof"), stored(means, "test-scores"), models


def average_folds(parts: Sequence[DataFrame], id_column: str, score: str) -> DataFrame:
    """Mean score per id over per-fold score tables."""
    return reduce(DataFrame.unionByName, [p.select(id_column, score) for p in parts]).groupBy(
        id_column).agg(F.avg(score).alias(score))


def stack(oof: DataFrame, test: DataFrame, scores: Sequence[str], id_column: str, rows: int,
          folds: int = 3, c: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Logistic regression over the candidates' scores, itself out of fold; adds column ``stacked``.

    The other columns of both tables travel with their rows. ``rows`` is the number of out-of-fold rows, of
    which each of the fits sees all but one fold.
    """
    kept = [c_ for c_ in oof.columns if c_ not in (id_column, LABEL, "fold")]
    seen = rows - rows // folds if folds > 1 else rows
    vectors = assemble(oof.drop("fold"), scores)
    test_vectors = assemble(test, scores)
    stacked, test_stacked, _ = out_of_fold(
        vectors, test_vectors, lambda _: {"stacked": logistic(seen, c, weighted=False)}, id_column, folds, carry=kept)
    return stacked.drop("fold"), test_stacked


# ---- importances

def importances(spark, model: Model | BoosterModel, names: Sequence[str]) -> DataFrame:
    """(feature, importance): tree importances or absolute coefficients of the first class row."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficientMatrix.toArray()[0])
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def top_importances(table: DataFrame, k: int = 20) -> DataFrame:
    return table.orderBy(F.col("importance").desc(), "feature").limit(k)


def merge_importances(tables: Mapping[str, DataFrame], k: int = 20, normalise: bool = True) -> DataFrame:
    """Features all tables share, one column per table, and their mean, largest first.

    Importances of different models have different scales, so each table is scaled to sum 1 first.
    """
    def one(name: str, table: DataFrame) -> DataFrame:
        whole = table.agg(F.sum("importance")).scalar() if normalise else F.lit(1.0)
        return table.select("feature", F.try_divide(F.col("importance"), whole).alias(name))
    merged = reduce(lambda a, b: a.join(b, "feature"), [one(n, d) for n, d in tables.items()])
    mean = row_mean(*[F.col(n) for n in tables])
    return merged.withColumn("average", mean).orderBy(F.col("average").desc(), "feature").limit(k)
