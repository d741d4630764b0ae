"""One training run: from stored features to saved models, metrics and run tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.constants import CLASSIFIER_PARAMS, FOREST_PARAMS, MIN_TRAINING_ROWS, MODEL_FEATURES, SPLIT
from riskloom.operators import evaluate as ev
from riskloom.operators import models as mo
from riskloom.operators import prepare as pr
from riskloom.session import stored
from riskloom.sources.sinks import append_batch, save_model, write_importance


def record_run(spark, folder: str, run: int, params: Mapping[str, object], metrics: DataFrame, tags: Mapping[str, str]) -> None:
    """Append a run to the tables ``run_params``, ``run_tags`` (name, value) and
    ``run_metrics`` (split, metric, value); repeating a run number replaces it."""
    for table, values in (("run_params", params), ("run_tags", tags)):
        rows = [(k, str(v)) for k, v in values.items()]
        append_batch(spark.createDataFrame(rows, "name string, value string").coalesce(1), f"{folder}/{table}", run)
    append_batch(metrics, f"{folder}/run_metrics", run)


def train_run(
    features: DataFrame,
    folder: str,
    run: int,
    min_rows: int = MIN_TRAINING_ROWS,
    classifier_params: Mapping[str, float] | None = None,
    trees: int = FOREST_PARAMS["trees"],
    min_pr_auc: float = 0.20,
    min_recall: float = 0.40,
) -> dict[str, str]:
    """Train both models on a feature table, evaluate every split, apply the quality gate
    to the test split and store everything under the run number. Returns the run's tags.

    The labelled rows are stored once; each later step reads them back."""
    spark = features.sparkSession
    rows = stored(pr.labelled_scan(features, min_rows))
    split = pr.time_split(rows, SPLIT)
    prepared = stored(pr.prepared_features(split))

    model, stages = mo.train_classifier_by_area(prepared, params=classifier_params)
    scored = stored(
        mo.score(model, prepared).select("transaction_id", "split", (F.col("label") == 1).alias("label"), "score")
    )
    report = stored(ev.evaluation_report(scored))
    test = scored.where("split = 'test'")
    gate = ev.promotion_gate(ev.curve_metrics(ev.score_counts(test)), min_pr_auc, min_recall).first()
    best = ev.optimal_threshold(test).first()

    forest = mo.train_isolation_forest(prepared.where("split = 'train'"), trees=trees)
    unusual = stored(
        mo.anomaly_scores(forest, prepared.where("split = 'test'")).select(
            "transaction_id", (F.col("label") == 1).alias("label"), "anomaly_score"
        )
    )
    stretched = ev.normalised(unusual, "anomaly_score", "score").select("transaction_id", "label", "score")
    anomaly = ev.curve_metrics(ev.score_counts(stretched)).select("pr_auc", "roc_auc", "recall_at_5pct_fpr")
    anomaly = anomaly.select(F.lit("anomaly_test").alias("split"), "*").unpivot(
        "split", ["pr_auc", "roc_auc", "recall_at_5pct_fpr"], "metric", "value"
    )

    stats = pr.dataset_stats(rows).first()
    params = {
        **CLASSIFIER_PARAMS,
        **(classifier_params or {}),
        "trees": trees,
        "classifier_trees": model.stages[-1].getNumTrees,
        "features": ",".join(MODEL_FEATURES),
        "data_fingerprint": pr.data_fingerprint(rows).first()["fingerprint"],
        "optimal_threshold": best["optimal_threshold"] if best else None,
        **{k: stats[k] for k in ("total_rows", "fraud_count", "fraud_rate", "unique_users", "first_time", "last_time")},
    }
    tags = {
        "promotion_status": "promoted" if gate["promoted"] else "not_promoted",
        "model_stage": "production_candidate" if gate["promoted"] else "experimental",
        "promotion_reason": gate["reason"],
    }
    record_run(spark, folder, run, params, report.unionByName(anomaly), tags)
    append_batch(pr.split_stats(split), f"{folder}/run_splits", run)
    append_batch(stages, f"{folder}/run_stages", run)
    write_importance(mo.feature_importance(model), f"{folder}/importance/run={run}")
    save_model(model, folder, "classifier", run)
    forest.save(f"{folder}/isolation_forest/{run}")
    return tags
