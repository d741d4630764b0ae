"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from riskloom.operators.drift import drift_dataset, drift_report
from riskloom.operators.history import feature_rows
from riskloom.operators.prepare import drift_scan
from riskloom.plans.queries import all_queries
from riskloom.session import local_session
from riskloom.sources.tables import event_transactions

HEADLINE = [
    "raw_projection", "raw_dedup", "quarantine_stats", "feature_upsert",
    "features_full", "history_exact", "home_country", "idle_reset", "rolling_scores",
    "time_split", "prepared_features", "dataset_stats",
    "roc_auc", "pr_auc", "optimal_threshold", "lift", "evaluation_report",
    "top_features", "risk_factors", "alerts", "alert_stats", "alert_outcomes",
    "psi", "drift_report", "drift_by_window",
    "throughput", "increase_1h", "latency_quantiles",
    "train_classifier", "score_batch", "anomaly_scores",
]


def stored_drift_check(spark, folder: str) -> float:
    """One drift check of 5,000 first and 1,000 last rows of features that are stored already."""
    path = f"{tempfile.mkdtemp(prefix='riskloom-bench-')}/features"
    feature_rows(event_transactions(spark, folder)).write.parquet(path)
    start = time.perf_counter()
    features = spark.read.parquet(path)
    report = drift_report(drift_scan(features, "reference"), drift_scan(features, "current"))
    drift_dataset(report).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    known["data_stats"](spark, folder).collect()  # start the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    seconds["drift_check_stored"] = stored_drift_check(spark, folder)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
