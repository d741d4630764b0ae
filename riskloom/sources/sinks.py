"""Table sinks for streams: repeatable appends and keyed merges on plain Parquet.

Each micro-batch owns the folder ``batch_id=N`` of a table and overwrites it, so a
retried batch leaves the same result. Readers see the batches as one table; a keyed
table is merged when read and can be compacted into a new folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import RECOMPUTED, TRANSACTION_FEATURES, columns_of
from riskloom.sources.messages import OFFSET

BATCH = "batch_id"
BUCKETS = 256


def append_batch(df: DataFrame, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")


def append_dated_batch(df: DataFrame, table: str, batch_id: int, time: str = "event_time") -> None:
    """Append with day folders inside the batch, so readers can skip days."""
    (
        df.withColumn("event_date", F.to_date(time))
        .write.mode("overwrite")
        .partitionBy("event_date")
        .parquet(f"{table}/{BATCH}={batch_id}")
    )


def read_batches(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """All batches of a table, or those before one batch; None when none holds a row yet."""
    try:
        df = spark.read.option("basePath", table).parquet(f"{table}/{BATCH}=*")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df if before is None else df.where(F.col(BATCH) < before)


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def append_bucketed(df: DataFrame, table: str, batch_id: int, key: str) -> None:
    """Append in folders by a hash of ``key``, so that readers of some keys skip the rest;
    one task writes a bucket, so a batch adds one file to each bucket it touches."""
    (
        df.withColumn("bucket", bucket_of(key))
        .repartition(F.col("bucket"))
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(f"{table}/{BATCH}={batch_id}")
    )


def read_buckets(spark: SparkSession, table: str, rows: DataFrame, key: str, before: int) -> DataFrame | None:
    """Earlier batches of a bucketed table, the buckets that the keys of ``rows`` fall in."""
    stored = read_batches(spark, table, before)
    if stored is None:
        return None
    touched = [r[0] for r in rows.select(bucket_of(key).alias("b")).distinct().collect()]  # BUCKETS at most
    return stored.where(F.col("bucket").isin(touched)).drop("bucket", BATCH)


def append_ids(rows: DataFrame, table: str, batch_id: int) -> None:
    """The ids and message offsets of a batch."""
    append_bucketed(rows.select("transaction_id", *OFFSET), table, batch_id, "transaction_id")


def known_ids(spark: SparkSession, table: str, rows: DataFrame, before: int) -> DataFrame | None:
    """Ids and offsets of earlier batches, whatever their dates, that may concern ``rows``:
    a repeated message falls in the bucket of its first copy."""
    return read_buckets(spark, table, rows, "transaction_id", before)


def merge_rows(rows: DataFrame, version: str, key: str = "transaction_id") -> DataFrame:
    """One row per key: recomputed columns from the newest version, all others from the
    first. A partial aggregate, so many versions of one key do not meet in one task."""
    newest = [c for c in rows.columns if c in RECOMPUTED]
    kept = [c for c in rows.columns if c not in RECOMPUTED and c not in (key, version)]
    merged = rows.groupBy(key).agg(
        F.min_by(F.struct(*kept), version).alias("_first"),
        F.max_by(F.struct(*newest), version).alias("_last"),
    )
    columns = {key: F.col(key)}
    columns |= {c: F.col(f"_first.{c}") for c in kept} | {c: F.col(f"_last.{c}") for c in newest}
    return merged.select(*[columns[c].alias(c) for c in rows.columns if c != version])


def stored_features(features: DataFrame) -> DataFrame:
    """A feature frame in the stored column order and types. Values that do not fit
    (a z-score of 10,000 or more) become NULL; ``overflows`` counts them."""
    names = set(features.columns)
    columns = []
    for name, kind in columns_of(TRANSACTION_FEATURES).items():
        if name in names:
            columns.append(F.col(name).try_cast(kind).alias(name))
        elif name == "computed_at":
            columns.append(F.current_timestamp().alias(name))
        else:
            columns.append(F.lit(None).cast(kind).alias(name))
    return features.select(*columns)


def overflows(features: DataFrame) -> DataFrame:
    """How many z-scores the stored type cannot hold."""
    z = F.col("amount_zscore")
    return features.agg(
        F.count_if(z.isNotNull() & z.try_cast("decimal(8,4)").isNull()).alias("zscore_overflows")
    )


def current_features(spark: SparkSession, table: str) -> DataFrame | None:
    """The feature table as readers see it: every id once, over all batches."""
    batches = read_batches(spark, table)
    return None if batches is None else merge_rows(batches.drop("event_date"), BATCH)


def compact(spark: SparkSession, table: str, target: str) -> None:
    """Write the merged table to a new folder as its first batch."""
    merged = current_features(spark, table)
    if merged is not None:
        append_dated_batch(merged, target, 0)


def save_model(model, folder: str, name: str, version: int) -> str:
    path = f"{folder}/{name}/{version}"
    model.write().overwrite().save(path)
    return path


def write_importance(importance: DataFrame, path: str) -> None:
    """The importance table as CSV, highest first; it has one row per model feature."""
    importance.orderBy(F.desc("importance")).coalesce(1).write.mode("overwrite").csv(path, header=True)
