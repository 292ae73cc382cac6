"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Every result is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from riskloom.catalog import QUERIES
from riskloom.session import local_session

HEADLINE = (
    "basic_check_lineitem",
    "weekly_outcome_drift",
    "cumulative_drift",
    "intake_panel",
    "integrity_audit",
    "missing_plan",
    "impute_median",
    "impute_by_plan",
    "outlier_report",
    "apply_outliers",
    "describe_columns",
    "top_values",
    "histogram",
    "crosstab_pct",
    "box_stats",
    "trajectory_features",
    "signal_features",
    "topic_quadrants",
    "correlation_matrix",
    "correlation_trajectory",
    "stratified_split",
    "classification_report",
    "roc_auc",
    "fairness_overall",
    "top_k_per_tier",
    "top_drivers",
    "cohort_radar",
    "policy_simulation",
    "clean_students",
    "stream_weekly_panel",
    "l1_importance",
    "forest_importance",
    "model_comparison",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    folder = tempfile.mkdtemp(prefix="bench-")  # one machine: its disk is shared by all tasks
    spark = local_session(cores, folder=folder)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )


if __name__ == "__main__":
    main()
