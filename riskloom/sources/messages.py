"""Transaction messages: sources, typed projection, checks, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import MESSAGE, MONEY, OPTIONAL_FIELDS, REQUIRED_FIELDS

OFFSET = ["kafka_topic", "kafka_partition", "kafka_offset"]

ENVELOPE = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = "transactions", max_per_trigger: int = 500_000
) -> DataFrame:
    """Streaming read of a topic from its beginning; progress lives in the query's own
    checkpoint, so independent queries each see every message. Needs Spark's Kafka
    connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
        .withColumn("value", F.col("value").cast("string"))
        .withColumn("key", F.col("key").cast("string"))
    )


def file_messages(spark: SparkSession, folder: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of message envelopes landed as JSON files."""
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(folder)
    )


def _time(field: str) -> Column:
    return F.expr(f"try_to_timestamp(m.{field})")


def parse_messages(messages: DataFrame) -> DataFrame:
    """Type every message and list what is wrong with it in ``reasons``.

    The result has all columns of the raw event table plus ``reasons``; an empty array
    means the row is good. The untouched message stays in ``payload``."""
    # a generator keeps the parsed message as one column: as a plain expression it would
    # be copied into each of the many columns below and parsed again for each
    message = F.from_json("value", MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = messages.withColumn("m", F.explode(F.array(message)))
    broken = F.col("m").isNull() | F.col("m._corrupt_record").isNotNull()
    typed = parsed.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("received_at"),
        F.col("m.transaction_id").alias("transaction_id"),
        F.col("m.user_id").alias("user_id"),
        F.col("m.card_id").alias("card_id"),
        F.col("m.merchant_id").alias("merchant_id"),
        F.col("m.amount").try_cast(MONEY).alias("amount"),
        F.col("m.currency").alias("currency"),
        _time("timestamp").alias("event_time"),
        _time("ingestion_time").alias("ingestion_time"),
        F.col("m.channel").alias("channel"),
        F.col("m.country").alias("country"),
        F.col("m.city").alias("city"),
        F.col("m.device_id").alias("device_id"),
        F.col("m.ip_hash").alias("ip_hash"),
        F.col("m.label").try_cast("boolean").alias("label"),
        F.col("value").alias("payload"),
        broken.alias("_broken"),
        "m",
    )
    missing = [
        F.when(F.col(f"m.{name}").isNull(), F.lit(f"missing_{name}")) for name in REQUIRED_FIELDS
    ]
    bad = [
        F.when(F.col(f"m.{field}").isNotNull() & F.col(column).isNull(), F.lit(f"bad_{field}"))
        for field, column in (
            ("amount", "amount"),
            ("timestamp", "event_time"),
            ("ingestion_time", "ingestion_time"),
            ("label", "label"),
        )
    ]
    reasons = F.when(F.col("_broken"), F.array(F.lit("malformed_json"))).otherwise(
        F.array_compact(F.array(*missing, *bad))
    )
    return typed.withColumn("reasons", reasons).drop("_broken", "m")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("reasons") == 0).drop("reasons")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rows that cannot be processed, with their reasons and untouched payload."""
    return parsed.where(F.size("reasons") > 0).select(*OFFSET, "received_at", "payload", "reasons")


def feature_input(parsed: DataFrame) -> DataFrame:
    """What the feature job needs of a good row: no payload, arrival order as a column."""
    return parsed.select(
        "transaction_id", "user_id", "card_id", "merchant_id", "amount", "currency",
        "event_time", "channel", "country", "city", "device_id", "ip_hash", "label",
        F.struct("kafka_partition", "kafka_offset").alias("arrival"),
    )


def accept_new(rows: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to add to the raw table, and rejects.

    A repeated (topic, partition, offset) is the same message and is skipped. A known
    transaction id under a new offset is rejected. The first row per id is found with
    a partial aggregate, so many copies of one id do not meet in one task; both joins
    below are on columns unique in their tables."""
    fresh = rows.dropDuplicates(OFFSET)
    if stored is not None:
        fresh = fresh.join(stored.select(*OFFSET), OFFSET, "left_anti")
    order = F.struct("kafka_partition", "kafka_offset", "kafka_topic")
    firsts = fresh.groupBy("transaction_id").agg(
        F.min_by(F.struct(*fresh.columns), order).alias("first")
    ).select("first.*")
    accepted = firsts
    if stored is not None:
        accepted = firsts.join(stored.select("transaction_id"), "transaction_id", "left_anti")
        accepted = accepted.select(*fresh.columns)
    rejected = fresh.join(accepted.select(*OFFSET), OFFSET, "left_anti")
    return accepted, rejected


def messages_from(txn: DataFrame, partitions: int = 3, topic: str = "transactions") -> DataFrame:
    """Message envelopes for a transaction table, keyed by user. Used to replay stored
    transactions through the stream jobs."""
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    as_text = {
        "transaction_id": F.col("transaction_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "card_id": F.concat(F.lit("C"), F.col("user_id").cast("string"), F.lit("_1")),
        "merchant_id": F.col("merchant_id").cast("string"),
        "amount": F.col("amount"),
        "currency": F.lit("USD"),
        "timestamp": iso,
        "ingestion_time": iso,
        "channel": F.col("channel"),
        "country": F.col("country").cast("string"),
        "device_id": F.col("device_id").cast("string"),
        "label": F.col("label"),
    }
    assert set(as_text) <= set(REQUIRED_FIELDS + OPTIONAL_FIELDS)
    return txn.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*[c.alias(n) for n, c in as_text.items()])).alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("transaction_id").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )
