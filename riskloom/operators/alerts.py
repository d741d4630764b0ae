"""Decisions, alerts and what became of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import BLOCK_AT, REVIEW_AT, TOP_K
from riskloom.functions.columns import decision, half_up, ratio_or_zero
from riskloom.functions.explain import contributions, risk_factors
from riskloom.schemas import ALERTS, columns_of


def decide(scored: DataFrame, review_at: float = REVIEW_AT, block_at: float = BLOCK_AT) -> DataFrame:
    return scored.withColumn("decision", decision(F.col("score"), review_at, block_at))


def explain(
    scored: DataFrame, importances: Mapping[str, float], top_k: int = TOP_K, review_at: float = REVIEW_AT
) -> DataFrame:
    """Add ``top_features`` and ``risk_factors``; expects the scoring input columns."""
    return scored.withColumns(
        {
            "top_features": contributions(importances, top_k=top_k),
            "risk_factors": risk_factors(F.col("score"), review_at),
        }
    )


def new_alerts(
    decided: DataFrame,
    model_name: str,
    model_version: str,
    created_at: Column | None = None,
    review_at: float = REVIEW_AT,
    block_at: float = BLOCK_AT,
) -> DataFrame:
    """Alert rows for everything not approved, in the stored columns and types."""
    flagged = decided.where(F.col("decision") != "APPROVE")
    threshold = F.when(F.col("decision") == "REVIEW", review_at).otherwise(block_at)
    given = {
        "created_at": F.current_timestamp() if created_at is None else created_at,
        "score": half_up(F.col("score"), 4),
        "threshold": threshold,
        "top_features": F.to_json("top_features"),
        "model_name": F.lit(model_name),
        "model_version": F.lit(model_version),
        "inference_latency_ms": F.col("latency_ms") if "latency_ms" in decided.columns else F.lit(None),
    }
    columns = []
    for name, kind in columns_of(ALERTS).items():
        value = given.get(name)
        if value is None:
            value = F.col(name) if name in decided.columns else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return flagged.select(*columns)


def recent_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return (
        alerts.select(
            "transaction_id", "user_id", "amount", "channel", "country",
            "score", "decision", "created_at", "resolution",
        )
        .orderBy(F.desc("created_at"), F.desc("transaction_id"))
        .limit(limit)
    )


def alert_stats(alerts: DataFrame, now: Column) -> DataFrame:
    """Totals by decision, open alerts, averages, and the last hour before ``now``."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("decision") == "BLOCK").alias("blocked"),
        F.count_if(F.col("decision") == "REVIEW").alias("review"),
        F.count_if(F.col("decision") == "APPROVE").alias("approved"),
        F.count_if(F.col("resolution").isNull()).alias("unresolved"),
        F.avg("score").alias("avg_score"),
        F.avg("inference_latency_ms").alias("avg_latency_ms"),
        F.count_if(F.col("created_at") > now - F.expr("interval 1 hour")).alias("alerts_last_hour"),
    )


def alert_outcomes(alerts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """How many alerts of each decision turned out to be fraud, by transaction id."""
    joined = alerts.join(outcomes.select("transaction_id", "label"), "transaction_id", "left")
    fraud, clean = F.count_if(F.col("label")), F.count_if(~F.col("label"))
    return joined.groupBy("decision").agg(
        F.count(F.lit(1)).alias("alerts"),
        fraud.alias("fraud"),
        clean.alias("legitimate"),
        F.count_if(F.col("label").isNull()).alias("unlabelled"),
        ratio_or_zero(fraud, fraud + clean).alias("precision"),
    )
