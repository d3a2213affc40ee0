"""Metrics on scored rows, model choice and per-task summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.catalog.registry import Tables, query, r6
from tabula.operators import metrics


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


@query("metric_accuracy", "SELECT round(avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored")
def metric_accuracy(t: Tables):
    return _rounded(metrics.accuracy(t.derived("scored"), "y", "pred"), "accuracy")


_CLASS_SQL = """
classes AS (SELECT unnest([0, 1, 2]) AS k),
per AS (SELECT k, count(*) FILTER (y3 = k AND pred3 = k) AS tp, count(*) FILTER (y3 = k) AS support,
  count(*) FILTER (pred3 = k) AS said FROM classes, scored GROUP BY k),
score AS (SELECT k, tp, support, CASE WHEN said = 0 THEN 0 ELSE tp / said END AS p,
  CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r,
  CASE WHEN said + support = 0 THEN 0 ELSE 2 * tp / (said + support) END AS f FROM per)
"""


@query("metric_f1", f"""
WITH {_CLASS_SQL}
SELECT round(avg(f), 6) AS f1_macro, round(sum(f * support) / sum(support), 6) AS f1_weighted,
  (SELECT round(f, 6) FROM score WHERE k = 1) AS f1_binary FROM score
""")
def metric_f1(t: Tables):
    return _rounded(metrics.f1_scores(t.derived("scored"), "y3", "pred3"),
                    "f1_macro", "f1_weighted", "f1_binary")


@query("classification_report", f"""
WITH {_CLASS_SQL}
SELECT CAST(k AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM score
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM score
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM score
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM score
""")
def classification_report(t: Tables):
    return _rounded(metrics.classification_report(t.derived("scored"), "y3", "pred3"),
                    "precision", "recall", "f1")


@query("confusion_matrix", """
SELECT a.k AS actual, b.k AS predicted, (SELECT count(*) FROM scored WHERE y3 = a.k AND pred = b.k) AS n
FROM (SELECT unnest([0, 1, 2]) AS k) a, (SELECT unnest([0, 1, 2]) AS k) b
""")
def confusion_matrix(t: Tables):
    """Three classes against a predictor that never says class 2."""
    return metrics.confusion_matrix(t.derived("scored"), "y3", "pred")


@query("confusion_matrix_first", """
SELECT a.c AS actual, b.c AS predicted, count(p_partkey) AS n
FROM (SELECT DISTINCT p_brand AS c FROM part ORDER BY 1 LIMIT 10) a
CROSS JOIN (SELECT DISTINCT p_brand AS c FROM part ORDER BY 1 LIMIT 10) b
LEFT JOIN part ON p_brand = a.c AND 'Brand#' || CAST(1 + p_size % 25 AS VARCHAR) = b.c GROUP BY 1, 2
""")
def confusion_matrix_first(t: Tables):
    guess = F.concat(F.lit("Brand#"), (1 + F.col("p_size") % 25).cast("string"))
    return metrics.confusion_matrix(t.part.select("p_brand", guess.alias("guess")), "p_brand", "guess", first=10)


def _auc_sql(score: str, label: str = "y", source: str = "scored") -> str:
    return f"""(SELECT (sum(r) FILTER ({label} = 1) - count(*) FILTER ({label} = 1) * (count(*) FILTER ({label} = 1) + 1.0) / 2)
      / (count(*) FILTER ({label} = 1) * count(*) FILTER ({label} = 0)) AS auc
    FROM (SELECT {label}, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r FROM {source}))"""


@query("metric_auc", f"SELECT round(auc, 6) AS auc FROM {_auc_sql('score')}")
def metric_auc(t: Tables):
    return _rounded(metrics.auc(t.derived("scored"), "y", "score"), "auc")


@query("metric_auc_ovr", "SELECT round(avg(auc), 6) AS auc FROM (" + " UNION ALL ".join(
    "SELECT auc FROM " + _auc_sql(s, "z", f"(SELECT CAST(y3 = {k} AS INTEGER) AS z, {s} FROM scored)")
    for k, s in enumerate(["score", "score_b", "score_c"])) + ")")
def metric_auc_ovr(t: Tables):
    rows = t.derived("scored").withColumn("scores", F.array("score", "score_b", "score_c"))
    return _rounded(metrics.auc_one_vs_rest(rows, "y3", "scores"), "auc")


@query("roc_curve", """
SELECT threshold, round(fp / (SELECT count(*) FROM scored WHERE y = 0), 6) AS fpr, round(tp / (SELECT count(*) FROM scored WHERE y = 1), 6) AS tpr
FROM (SELECT s.score_c AS threshold, sum(b.p) AS tp, sum(b.n) AS fp
  FROM (SELECT DISTINCT score_c FROM scored) s
  JOIN (SELECT score_c, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM scored GROUP BY 1) b ON b.score_c >= s.score_c
  GROUP BY 1)
UNION ALL SELECT NULL, 0.0, 0.0
""")
def roc_curve(t: Tables):
    return _rounded(metrics.roc_curve(t.derived("scored"), "y", "score_c"), "fpr", "tpr")


def _sweep_sql(score: str, name: str = "sweep") -> str:
    return f"""{name} AS (SELECT CAST(i AS INTEGER) AS position, (i + 5) / 50 AS threshold,
  (SELECT CASE WHEN count(*) FILTER (y = 1) + count(*) FILTER ({score} > (i + 5) / 50) = 0 THEN 0
    ELSE 2 * count(*) FILTER (y = 1 AND {score} > (i + 5) / 50)
      / (count(*) FILTER (y = 1) + count(*) FILTER ({score} > (i + 5) / 50)) END FROM scored) AS f1
  FROM range(25) AS g(i))"""


@query("threshold_sweep", f"WITH {_sweep_sql('score')} SELECT position, threshold, round(f1, 6) AS f1 FROM sweep")
def threshold_sweep(t: Tables):
    return _rounded(metrics.threshold_sweep(t.derived("scored"), "y", "score"), "f1")


@query("best_threshold", """
WITH g AS (SELECT (i + 20) / 100 AS threshold,
  (SELECT 2 * count(*) FILTER (y = 1 AND score_c > (i + 20) / 100)
     / (count(*) FILTER (y = 1) + count(*) FILTER (score_c > (i + 20) / 100)) FROM scored) AS f1 FROM range(35) AS r(i))
SELECT threshold AS best_threshold, round(f1, 6) AS best_f1 FROM g ORDER BY f1 DESC, threshold LIMIT 1
""")
def best_threshold(t: Tables):
    return _rounded(metrics.best_threshold(
        t.derived("scored"), "y", "score_c", metrics.FINE_GRID), "best_f1")


@query("candidate_compare", "WITH " + ", ".join(
    _sweep_sql(s, f"sweep_{s}") for s in ("score", "score_b", "score_c")) + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{s}' AS model, (SELECT round(auc, 6) FROM {_auc_sql(s)}) AS auc,
  (SELECT threshold FROM sweep_{s} ORDER BY f1 DESC, position LIMIT 1) AS best_threshold,
  (SELECT round(max(f1), 6) FROM sweep_{s}) AS best_f1""" for s in ("score", "score_b", "score_c")))
def candidate_compare(t: Tables):
    out = metrics.compare_candidates(t.derived("scored"), "y", ["score", "score_b", "score_c"])
    return _rounded(out, "auc", "best_f1")


def _model_table(t: Tables) -> DataFrame:
    """Accuracy of a fixed rule per line number (the model) and line status (the task)."""
    hit = (F.col("l_returnflag") == "R") == (F.col("l_discount") > 0.05)
    return t.lineitem.groupBy(
        F.col("l_linestatus").alias("task"),
        F.concat(F.lit("model "), F.col("l_linenumber").cast("string")).alias("model")).agg(
        F.avg(hit.cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


_MODEL_SQL = """models AS (SELECT l_linestatus AS task, 'model ' || l_linenumber AS model,
  avg(CASE WHEN (l_returnflag = 'R') = (l_discount > 0.05) THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS rows
  FROM lineitem GROUP BY ALL)"""


@query("best_model", f"""
WITH {_MODEL_SQL} SELECT task, model, round(accuracy, 6) AS accuracy, rows FROM models
ORDER BY models.accuracy DESC, model LIMIT 1
""")
def best_model(t: Tables):
    return _rounded(metrics.best_model(_model_table(t), "accuracy"), "accuracy")


@query("task_summary", f"""
WITH {_MODEL_SQL}
SELECT 'task ' || task AS task, sum(rows) || ' samples' AS data,
  arg_min(model, -accuracy) AS best_model, round(max(accuracy), 6) AS score
FROM models GROUP BY 1
""")
def task_summary(t: Tables):
    """One row per task: data size, best model, its score."""
    table = _model_table(t)
    parts = []
    for task in ("F", "O"):
        mine = table.where(F.col("task") == task)
        parts.append(metrics.best_model(mine, "accuracy").select(
            F.concat(F.lit("task "), "task").alias("task"),
            F.concat(mine.agg(F.sum("rows")).scalar().cast("string"), F.lit(" samples")).alias("data"),
            F.col("model").alias("best_model"), r6("accuracy").alias("score")))
    return reduce(DataFrame.unionByName, parts)
