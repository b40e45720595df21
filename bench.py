"""Time the headline queries: one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Every query runs once to warm up and then BENCH_RUNS times (2); the median counts. A
run includes the fit and scores every row (the result is written to nowhere).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.catalog import QUERIES
from millrace.session import local_session

HEADLINE = [
    "standard_scaler", "robust_scaler", "vector_summary", "correlation_spearman", "string_indexer", "idf",
    "linear_regression", "logistic_regression", "random_forest_classifier", "k_means", "als",
    "recommend_for_users", "fp_growth", "prefix_span", "similar_documents", "multiclass_report",
    "multiclass_classification_evaluator", "cross_validation", "price_model_by_flag",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="bench", **{"spark.ui.showConsoleProgress": "false"})
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
