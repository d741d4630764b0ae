"""Schemas of the message stream and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of a transaction message. They are read as text and typed afterwards, so that
# one bad field sends one row to quarantine instead of failing the job.
REQUIRED_FIELDS = [
    "transaction_id",
    "user_id",
    "card_id",
    "merchant_id",
    "amount",
    "currency",
    "timestamp",
    "ingestion_time",
    "channel",
    "country",
]
OPTIONAL_FIELDS = ["city", "device_id", "ip_hash", "label"]

MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in REQUIRED_FIELDS + OPTIONAL_FIELDS]
    + [T.StructField("_corrupt_record", T.StringType())]
)

MONEY = "decimal(12,2)"
Z_SCORE = "decimal(8,4)"
SCORE = "decimal(6,4)"

RAW_EVENTS = (
    "kafka_topic string, kafka_partition int, kafka_offset bigint, received_at timestamp, "
    "transaction_id string, user_id string, card_id string, merchant_id string, "
    f"amount {MONEY}, currency string, event_time timestamp, ingestion_time timestamp, "
    "channel string, country string, city string, device_id string, ip_hash string, "
    "label boolean, payload string"
)

TRANSACTION_FEATURES = (
    "transaction_id string, user_id string, event_time timestamp, computed_at timestamp, "
    f"amount {MONEY}, amount_zscore {Z_SCORE}, user_txn_count_1h int, user_txn_count_24h int, "
    f"user_txn_count_7d int, user_amount_sum_1h {MONEY}, user_amount_sum_24h {MONEY}, "
    f"user_avg_amount_30d {MONEY}, user_std_amount_30d {MONEY}, country_change_flag boolean, "
    "device_change_flag boolean, unique_countries_24h int, unique_merchants_24h int, "
    "unique_devices_24h int, user_merchant_first_time boolean, hour_of_day int, "
    "day_of_week int, is_weekend boolean, is_night boolean, minutes_since_last_txn int, "
    "channel string, channel_encoded int, country string, is_foreign_txn boolean, label boolean"
)

ALERTS = (
    f"transaction_id string, created_at timestamp, score {SCORE}, threshold {SCORE}, "
    "decision string, top_features string, model_name string, model_version string, "
    f"inference_latency_ms int, user_id string, amount {MONEY}, channel string, "
    "country string, resolved_at timestamp, resolution string, resolved_by string, "
    "resolution_notes string"
)



def columns_of(ddl: str) -> dict[str, str]:
    """Column names and types of one of the table definitions above."""
    return dict(part.split(" ", 1) for part in ddl.split(", "))


# Columns a repeated write replaces; all other columns keep the first stored value.
RECOMPUTED = [
    "amount_zscore",
    "user_txn_count_1h",
    "user_txn_count_24h",
    "user_txn_count_7d",
    "user_amount_sum_1h",
    "user_amount_sum_24h",
    "user_avg_amount_30d",
    "user_std_amount_30d",
    "country_change_flag",
    "device_change_flag",
    "unique_countries_24h",
    "unique_merchants_24h",
    "unique_devices_24h",
    "user_merchant_first_time",
    "minutes_since_last_txn",
    "computed_at",
]
