"""A whole training run, and scoring a stream of features with its model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.operators import models as mo
from riskloom.operators.history import feature_rows
from riskloom.plans.training import train_run
from riskloom.sources import sinks
from riskloom.sources.tables import event_transactions
from riskloom.streaming import jobs


def test_training_run_and_scoring_stream(spark, tables, tmp_path):
    folder = str(tmp_path)
    features = sinks.stored_features(feature_rows(event_transactions(spark, tables)))
    features.withColumn("day", F.lit(1)).write.parquet(f"{folder}/features")
    stored = spark.read.parquet(f"{folder}/features")
    tags = train_run(stored, folder, 1, min_rows=500, classifier_params={"maxIter": 4}, trees=10)
    assert tags["promotion_status"] in ("promoted", "not_promoted")
    metrics = sinks.read_batches(spark, f"{folder}/run_metrics")
    assert {r[0] for r in metrics.select("split").distinct().collect()} == {"train", "val", "test", "anomaly_test"}
    params = {r["name"]: r["value"] for r in sinks.read_batches(spark, f"{folder}/run_params").collect()}
    assert "data_fingerprint" in params
    kept = sinks.read_batches(spark, f"{folder}/run_stages").where("chosen").collect()
    assert [str(r["trees"]) for r in kept] == [params["classifier_trees"]]
    forest = mo.IsolationForest.load(spark, f"{folder}/isolation_forest/1")
    assert forest.nodes.select("tree").distinct().count() == 10

    model = mo.load_model(folder, "classifier", 1)
    stream = spark.readStream.schema(stored.schema).parquet(f"{folder}/features")
    jobs.start_scoring(stream, folder, model, "classifier", "1").awaitTermination()
    decisions = sinks.read_batches(spark, f"{folder}/decisions")
    alerts = sinks.read_batches(spark, f"{folder}/alerts")
    assert decisions.count() == 1000
    assert alerts.count() == decisions.where("decision <> 'APPROVE'").count()
    assert alerts.where("decision not in ('REVIEW', 'BLOCK') or top_features is null").count() == 0


def test_chosen_stage(spark):
    def chosen(areas, patience):
        rows = spark.createDataFrame([(k + 1, float(a)) for k, a in enumerate(areas)], "trees int, pr_auc double")
        out = mo.chosen_stage(rows, patience).orderBy("trees").collect()
        return [r["trees"] for r in out if r["chosen"]], sum(r["reached"] for r in out)

    assert chosen([0.1, 0.3, 0.2, 0.25, 0.9], 2) == ([2], 4)  # the later optimum comes too late
    assert chosen([0.1, 0.3, 0.2, 0.25, 0.9], 3) == ([5], 5)
    assert chosen([0.5, 0.5, 0.5], 10) == ([1], 3)  # ties: the fewest trees
    assert chosen([0.0, 0.0, 0.0], 1) == ([3], 2)  # nothing to judge by
    assert chosen([], 1) == ([], 0)


def test_training_stops_at_the_best_area(spark):
    """The val split follows the first trees' pattern and contradicts what later ones learn."""
    draw = np.random.default_rng(5)
    rows = []
    for k in range(600):
        amount, hour = draw.uniform(), draw.uniform()
        train = k < 400
        noise = hour > 0.8 and train  # holds in the train split only
        rows.append((k, "train" if train else "val", int(amount > 0.7 or noise), amount, hour))
    df = spark.createDataFrame(rows, "transaction_id int, split string, label int, amount double, hour_of_day double").coalesce(1)
    params = {"maxIter": 12, "maxDepth": 1, "stepSize": 0.5}
    model, stages = mo.train_classifier_by_area(df, ["amount", "hour_of_day"], params, patience=12)
    table = stages.orderBy("trees").collect()
    assert len(table) == 12 and sum(r["chosen"] for r in table) == 1
    best = max(table, key=lambda r: (r["pr_auc"], -r["trees"]))
    assert best["chosen"] and best["trees"] == model.stages[-1].getNumTrees < 12
    # the kept trees are the first of the whole ensemble, so the areas are the same again
    val = df.where("split = 'val'").withColumn("label", F.col("label") == 1)
    again = {r["trees"]: r["pr_auc"] for r in mo.staged_pr_auc(model, val).collect()}
    assert again == {r["trees"]: r["pr_auc"] for r in table if r["trees"] in again} and len(again) == best["trees"]
    whole = ev.curve_metrics(ev.score_counts(mo.score(model, val).select("label", "score"))).first()
    assert again[best["trees"]] == pytest.approx(whole["pr_auc"], abs=1e-3)
