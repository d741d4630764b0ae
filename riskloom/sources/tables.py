"""Table readers: Parquet tables and the adapters that present them as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import cents, micros


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as payment transactions (see FIXTURES)."""
    kind, value = F.col("event_type"), F.col("value")
    base = read_table(spark, folder, "events").select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        value.alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(kind.isin("click", "view"), "POS")
        .when(kind == "purchase", "ECOM")
        .when(kind == "signup", "ATM")
        .otherwise("OTHER")
        .alias("channel"),
        (F.col("user_id") % 9).alias("home"),
    )
    k, country, home = F.col("k"), F.col("country"), F.col("home")
    placed = base.withColumns(
        {
            "us": micros(F.col("event_time")),
            "cents": cents(F.col("amount")),
            "country": F.when(k < 80, home).otherwise((k % 9).cast("bigint")),
            "merchant_id": k,
        }
    )
    abroad = F.when(country != home, F.lit(0.2)).otherwise(F.lit(0.0))
    return placed.withColumns(
        {
            "device_id": F.when(F.col("channel") != "POS", k % 10),
            "label": F.when(
                k % 20 != 0,
                (F.col("amount") >= 150)
                | ((F.col("channel") == "ECOM") & (country != home) & (F.col("amount") >= 50)),
            ),
            "score": F.least(
                F.lit(0.99),
                F.floor((F.col("amount") / 250.0 + abroad) * 1000).cast("double") / 1000.0,
            ),
            "latency_ms": F.lit(5) + F.col("transaction_id") % 97,
        }
    )


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The ``orders`` table as transactions: sparse users, ties at midnight."""
    orders = read_table(spark, folder, "orders")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    status = F.col("o_orderstatus")
    return orders.join(customers, orders.o_custkey == customers.c_custkey, "left").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_totalprice").alias("amount"),
        F.when(status == "O", "ECOM").when(status == "F", "POS").when(status == "P", "ATM")
        .otherwise("OTHER").alias("channel"),
        F.col("c_nationkey").alias("home"),
        F.col("c_nationkey").alias("country"),
        (F.col("o_orderkey") % 250).alias("merchant_id"),
        F.lit(None).cast("bigint").alias("device_id"),
    )
