"""Evaluation metrics as plain aggregates.

Every metric first counts rows per distinct outcome (class pair, score, or thresholds passed), with
map-side partial counts, and works on that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.operators.sizing import attach, running_sums

# The two search grids, 0.10..0.58 step 0.02 and 0.20..0.54 step 0.01.
COARSE_GRID = [i / 50 for i in range(5, 30)]
FINE_GRID = [i / 100 for i in range(20, 55)]
DEFAULT_THRESHOLD = 0.5


def accuracy(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg((F.col(label) == F.col(predicted)).cast("int")).alias("accuracy"))


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def class_scores(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(class, precision, recall, f1, support, hits) per class seen as label or prediction."""
    cells = df.groupBy(*by, label, predicted).agg(F.count(F.lit(1)).alias("_n"))
    # one row per class pair becomes one for its label and one for its prediction
    sides = cells.select(*by, F.inline(F.array(
        F.struct(F.col(label).alias("class"), F.col("_n").alias("_actual"), F.lit(0).alias("_said"),
                 F.when(F.col(label) == F.col(predicted), F.col("_n")).otherwise(F.lit(0)).alias("_hit")),
        F.struct(F.col(predicted).alias("class"), F.lit(0).alias("_actual"), F.col("_n").alias("_said"),
                 F.lit(0).alias("_hit")))))
    sums = sides.groupBy(*by, "class").agg(
        F.sum("_actual").alias("support"), F.sum("_said").alias("said"), F.sum("_hit").alias("hits"))
    return sums.select(
        *by, "class",
        _or_zero(F.col("hits"), F.col("said")).alias("precision"),
        _or_zero(F.col("hits"), F.col("support")).alias("recall"),
        _or_zero(2 * F.col("hits"), F.col("said") + F.col("support")).alias("f1"),
        "support", "hits")


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.sum("support")


def f1_scores(df: DataFrame, label: str, predicted: str, by: Sequence[str] = (),
              positive: int = 1) -> DataFrame:
    """Macro, weighted and binary (positive class) F1."""
    return class_scores(df, label, predicted, by).groupBy(*by).agg(
        F.avg("f1").alias("f1_macro"), _weighted("f1").alias("f1_weighted"),
        F.coalesce(F.max(F.when(F.col("class") == positive, F.col("f1"))), F.lit(0.0)).alias("f1_binary"))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support): one row per class, then accuracy, macro and weighted."""
    classes = class_scores(df, label, predicted)
    rows = classes.select(F.col("class").cast("string").alias("label"),
                          "precision", "recall", "f1", "support")
    right = F.sum("hits") / F.sum("support")
    means = classes.agg(F.array(
        F.struct(F.lit("accuracy").alias("label"), right.alias("precision"), right.alias("recall"),
                 right.alias("f1"), F.sum("support").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                 F.sum("support").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), _weighted("precision").alias("precision"),
                 _weighted("recall").alias("recall"), _weighted("f1").alias("f1"),
                 F.sum("support").alias("support"))).alias("_rows")).select(F.inline("_rows"))
    return rows.unionByName(means)


def confusion_matrix(df: DataFrame, label: str, predicted: str, first: int | None = None) -> DataFrame:
    """(actual, predicted, n) for every pair of classes, zeros included; optionally only the first
    classes in order. The number of cells is the number of classes squared, whatever the rows."""
    counts = df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("_n"))
    seen = F.array_sort(F.array_union(F.collect_set("actual"), F.collect_set("predicted")))
    classes = counts.agg((F.slice(seen, 1, first) if first else seen).alias("_classes"))
    cells = classes.select("_classes", F.explode("_classes").alias("actual")).select(
        "actual", F.explode("_classes").alias("predicted"))
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("_n", F.lit(0)).alias("n"))


def _score_cells(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; tied scores count half, one missing class gives NULL."""
    along = running_sums(_score_cells(df, label, score, by), by, score, {"_neg": "_upto"})
    won = F.sum(F.col("_pos").cast("double") * (F.col("_upto") - F.col("_neg") / 2))
    return along.groupBy(*by).agg(
        F.try_divide(won, F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))


def auc_one_vs_rest(df: DataFrame, label: str, scores: str, by: Sequence[str] = ()) -> DataFrame:
    """Macro mean of the per-class areas; ``scores`` is an array with one score per class number."""
    long = df.select(*by, label, F.posexplode(scores).alias("_class", "_score")).withColumn(
        "_is", (F.col(label) == F.col("_class")).cast("int"))
    per_class = auc(long, "_is", "_score", [*by, "_class"])
    return per_class.groupBy(*by).agg(
        F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, highest first, after the (0, 0) start, whose
    threshold is NULL."""
    along = running_sums(_score_cells(df, label, score, []), [], score,
                         {"_pos": "_tp", "_neg": "_fp"}, totals={"_pos": "_p", "_neg": "_n"}, descending=True)
    points = along.select(
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("_fp").cast("double"), F.col("_n")).alias("fpr"),
        F.try_divide(F.col("_tp").cast("double"), F.col("_p")).alias("tpr"))
    start = along.agg(F.count(F.lit(1))).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                          F.lit(0.0).alias("tpr"))
    return start.unionByName(points)




def threshold_sweep(df: DataFrame, label: str, score: str, grid: Sequence[float] = COARSE_GRID,
                    by: Sequence[str] = ()) -> DataFrame:
    """(position, threshold, f1) per grid threshold, predicting 1 above it.

    Each row only notes how many thresholds it passes; the at most len(grid)+1 counts per group are
    then spread over the grid, so rows are never multiplied.
    """
    passed = sum((F.coalesce((F.col(score) > t).cast("int"), F.lit(0)) for t in grid[1:]),
                 F.coalesce((F.col(score) > grid[0]).cast("int"), F.lit(0)))
    cells = df.groupBy(*by, passed.alias("_passed")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    spread = cells.select(
        *by, "_passed", "_pos", "_neg",
        F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("position", "threshold"))
    above = F.col("_passed") > F.col("position")
    sums = spread.groupBy(*by, "position", "threshold").agg(
        F.sum(F.when(above, F.col("_pos")).otherwise(0)).alias("_tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(0)).alias("_fp"), F.sum("_pos").alias("_p"))
    return sums.select(*by, "position", "threshold", _or_zero(
        2 * F.col("_tp"), F.col("_tp") + F.col("_fp") + F.col("_p")).alias("f1"))


def best_threshold(df: DataFrame, label: str, score: str, grid: Sequence[float] = COARSE_GRID,
                   by: Sequence[str] = ()) -> DataFrame:
    """(best_threshold, best_f1): the first grid maximum; the default when no threshold scores."""
    best = threshold_sweep(df, label, score, grid, by).groupBy(*by).agg(
        F.max(F.struct("f1", -F.col("position"), "threshold")).alias("_best"))
    return best.select(
        *by,
        F.when(F.col("_best.f1") > 0, F.col("_best.threshold")).otherwise(DEFAULT_THRESHOLD)
        .alias("best_threshold"),
        F.col("_best.f1").alias("best_f1"))


def compare_candidates(df: DataFrame, label: str, scores: Sequence[str],
                       grid: Sequence[float] = COARSE_GRID) -> DataFrame:
    """(model, auc, best_threshold, best_f1) per score column."""
    long = df.select(label, *scores).unpivot([label], list(scores), "model", "_score")
    return attach(auc(long, label, "_score", ["model"]),
                  best_threshold(long, label, "_score", grid, ["model"]), "model")


def best_model(metrics: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """The model with the largest metric (per group); equal metrics in model order."""
    if not by:
        return metrics.orderBy(F.col(metric).desc_nulls_last(), "model").limit(1)
    first = F.min_by(F.struct(*metrics.columns), F.struct(
        F.coalesce(-F.col(metric), F.lit(float("inf"))), F.col("model")))
    return metrics.groupBy(*by).agg(first.alias("_row")).select("_row.*")
