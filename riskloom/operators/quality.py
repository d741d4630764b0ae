"""Row checks, table constraints, reference checks and error counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import DECISIONS, ERROR_BUDGET, RESOLUTIONS

REQUEST_FIELDS = ["transaction_id", "user_id", "amount", "channel", "country", "merchant_id"]
FEATURE_ROW_FIELDS = [f for f in REQUEST_FIELDS if f != "merchant_id"]  # stored features name no merchant


def request_reasons(fields: Sequence[str] = REQUEST_FIELDS) -> Column:
    """What makes a row unfit for scoring, as an array (empty when fit)."""
    missing = [F.when(F.col(n).isNull(), F.lit(f"missing_{n}")) for n in fields]
    return F.array_compact(
        F.array(*missing, F.when(F.col("amount") <= 0, F.lit("amount_not_positive")))
    )


def split_requests(rows: DataFrame, fields: Sequence[str] = REQUEST_FIELDS) -> tuple[DataFrame, DataFrame]:
    checked = rows.withColumn("reasons", request_reasons(fields))
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def reason_counts(rejected: DataFrame, *by: str) -> DataFrame:
    return rejected.select(*by, F.explode("reasons").alias("reason")).groupBy(*by, "reason").agg(
        F.count(F.lit(1)).alias("errors")
    )


def within_error_budget(rejected: DataFrame, budget: int = ERROR_BUDGET) -> bool:
    """Whether a batch stays inside the error budget; stops counting once it is spent."""
    return rejected.limit(budget + 1).count() <= budget


def alert_rules() -> dict[str, Column]:
    return {
        "decision_known": F.col("decision").isin(*DECISIONS),
        "resolution_known": F.col("resolution").isNull() | F.col("resolution").isin(*RESOLUTIONS),
        "transaction_id_set": F.col("transaction_id").isNotNull(),
        "score_set": F.col("score").isNotNull(),
        "amount_set": F.col("amount").isNotNull(),
    }


# fixed values: columns that may not be NULL in the stored tables
RAW_REQUIRED = [
    "kafka_topic", "kafka_partition", "kafka_offset", "transaction_id", "user_id", "card_id",
    "merchant_id", "amount", "currency", "event_time", "ingestion_time", "channel", "country", "payload",
]
FEATURE_REQUIRED = ["transaction_id", "user_id", "event_time", "amount"]


def required_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c}_set": F.col(c).isNotNull() for c in columns}


def violations(table: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, one line per rule, in one pass over the table."""
    counts = table.agg(
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "violations")


def orphans(features: DataFrame, raw: DataFrame) -> DataFrame:
    """Feature rows without a raw event."""
    return features.join(raw.select("transaction_id"), "transaction_id", "left_anti")


def with_raw_event(features: DataFrame, raw: DataFrame) -> DataFrame:
    return features.join(raw.select("transaction_id"), "transaction_id", "left_semi")

