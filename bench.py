"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from tabula.catalog import QUERIES
from tabula.session import local_session

HEADLINE = [
    "explode_topk", "csv_robust_scan", "replace_unknowns", "clean_pulses", "clean_vulnerabilities", "dedup_keep_first",
    "duplicate_count", "null_profile", "share_by_category", "crosstab_counts", "describe_numeric",
    "median_exact", "histogram", "histogram_by_group", "corr_matrix", "monthly_counts", "burst_days",
    "is_last_in_group", "group_mean_std", "pct_rank_avg", "lap_features", "label_encode",
    "topn_else_other", "standardize", "ngrams", "vocab_topn", "tfidf", "stratified_split",
    "stratified_folds", "metric_auc", "roc_curve", "threshold_sweep", "candidate_compare",
    "classification_report", "report_pulses", "report_vulnerabilities", "kpi_matrix", "rf_fit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    # one warm-up of the code paths on the smallest tables, when they lie next to the measured ones
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in HEADLINE if os.path.isdir(small) else []:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
