"""Stream jobs: the batch operators applied to micro-batches.

Every job writes under ``batch_id``; a retried batch overwrites what it wrote before,
so each message has one effect however often a batch runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from riskloom.constants import DRIFT_CURRENT_ROWS, DRIFT_FEATURES, DRIFT_MIN_ROWS, DRIFT_REFERENCE_ROWS, ERROR_BUDGET
from riskloom.operators.alerts import new_alerts
from riskloom.operators.drift import drift_dataset, drift_report
from riskloom.operators.history import feature_rows
from riskloom.operators.models import score_and_explain
from riskloom.operators.prepare import drift_columns, drift_scan, enough_for_drift, scoring_input
from riskloom.operators.quality import FEATURE_ROW_FIELDS, REQUEST_FIELDS, split_requests, within_error_budget
from riskloom.operators import summaries as sm
from riskloom.session import broadcast_if_small, stored
from riskloom.sources.messages import accept_new, feature_input, good_rows, parse_messages, quarantined
from riskloom.sources.sinks import (
    append_batch,
    append_bucketed,
    append_dated_batch,
    append_ids,
    current_features,
    known_ids,
    read_batches,
    read_buckets,
    stored_features,
)


class ErrorBudgetSpent(RuntimeError):
    pass


def _start(stream: DataFrame, work, progress: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", progress)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# --- raw events ------------------------------------------------------------------


def ingest_batch(
    messages: DataFrame, batch_id: int, folder: str, error_budget: int | None = ERROR_BUDGET, since: int | None = None
) -> None:
    """Store new messages, rejects and quarantined rows of one micro-batch.

    ``since`` is the first batch of this run. Once the run's batches before this one have
    quarantined more than ``error_budget`` rows, it stops before touching anything: the
    batch that spent the budget is committed, and a new run goes on behind it."""
    spark = messages.sparkSession
    if error_budget is not None and since is not None:
        spent = read_batches(spark, f"{folder}/quarantine", before=batch_id)
        if spent is not None and not within_error_budget(spent.where(F.col("batch_id") >= since), error_budget):
            raise ErrorBudgetSpent(f"more than {error_budget} bad messages since batch {since}")
    parsed = parse_messages(messages).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = good_rows(parsed)
        accepted, rejected = accept_new(good, known_ids(spark, f"{folder}/raw_ids", good, batch_id))
        append_dated_batch(accepted, f"{folder}/raw_events", batch_id)
        append_batch(rejected, f"{folder}/rejects", batch_id)
        append_batch(quarantined(parsed), f"{folder}/quarantine", batch_id)
        append_ids(accepted, f"{folder}/raw_ids", batch_id)
    finally:
        parsed.unpersist()


def start_ingest(messages: DataFrame, folder: str, trigger: dict | None = None, error_budget: int | None = ERROR_BUDGET) -> StreamingQuery:
    run: dict[str, int] = {}
    return _start(
        messages,
        lambda df, i: ingest_batch(df, i, folder, error_budget, run.setdefault("since", i)),
        f"{folder}/_progress/ingest",
        trigger,
    )


# --- features ----------------------------------------------------------------------

# fixed values: the columns of the stored history
HISTORY_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount", "event_time",
    "channel", "country", "device_id", "label", "arrival",
]


def features_batch(messages: DataFrame, batch_id: int, folder: str, order: str = "arrival") -> None:
    """Features of one micro-batch: new rows join the earlier rows of the same users, the
    batch operator runs over both, and the new rows are kept. Equals the batch job. History
    lies in folders by a hash of the user; only those of the batch's users are read."""
    spark = messages.sparkSession
    good = good_rows(parse_messages(messages))
    rows, _ = accept_new(good, known_ids(spark, f"{folder}/feature_ids", good, batch_id))
    rows = stored(rows)
    new = feature_input(rows).select(*HISTORY_COLUMNS)
    history = read_buckets(spark, f"{folder}/history", new, "user_id", batch_id)
    if history is not None:
        users = broadcast_if_small(stored(new.select("user_id").distinct()))
        past = history.join(users, "user_id", "left_semi").select(*HISTORY_COLUMNS)
        both = past.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    else:
        both = new.withColumn("_new", F.lit(True))
    # an arrival is newer than every arrival of an earlier batch of the same user
    features = feature_rows(both, order=order, arrival="arrival").where("_new")
    edges = read_batches(spark, f"{folder}/drift_edges")
    if edges is not None:  # the batch is summarised as it is written; the rows are computed once
        features = stored(features)
        append_batch(sm.summarise(drift_columns(features), sm.read_edges(edges)), f"{folder}/drift_summaries", batch_id)
    append_dated_batch(stored_features(features), f"{folder}/transaction_features", batch_id)
    append_bucketed(new, f"{folder}/history", batch_id, "user_id")
    append_ids(rows, f"{folder}/feature_ids", batch_id)


def start_features(
    messages: DataFrame, folder: str, trigger: dict | None = None, order: str = "arrival"
) -> StreamingQuery:
    return _start(
        messages,
        lambda df, i: features_batch(df, i, folder, order),
        f"{folder}/_progress/features",
        trigger,
    )


# --- scores and alerts ---------------------------------------------------------------


def score_batch(
    rows: DataFrame, batch_id: int, folder: str, model: PipelineModel, name: str, version: str, clock: str = "event"
) -> None:
    """Score one micro-batch of feature rows, keep the decisions, append the alerts."""
    fields = REQUEST_FIELDS if "merchant_id" in rows.columns else FEATURE_ROW_FIELDS
    fit, unfit = split_requests(rows, fields)
    scored = score_and_explain(model, scoring_input(fit, clock=clock)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_batch(
            scored.select("transaction_id", "user_id", "score", "decision", "risk_factors"),
            f"{folder}/decisions",
            batch_id,
        )
        append_batch(new_alerts(scored, name, version), f"{folder}/alerts", batch_id)
        append_batch(unfit.select("transaction_id", "reasons"), f"{folder}/rejected_requests", batch_id)
    finally:
        scored.unpersist()


def start_scoring(
    features: DataFrame, folder: str, model: PipelineModel, name: str, version: str, trigger: dict | None = None
) -> StreamingQuery:
    return _start(
        features,
        lambda df, i: score_batch(df, i, folder, model, name, version),
        f"{folder}/_progress/scoring",
        trigger,
    )


# --- monitoring and drift --------------------------------------------------------------


def without_repeats(rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated ids that arrive within the delay, with bounded state."""
    return rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["transaction_id"])


def live_counts(rows: DataFrame, width: str = "1 minute", delay: str | None = "10 minutes", labels: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Events per (tumbling or sliding) window of a stream; windows close after the delay.
    ``delay=None`` keeps a watermark the rows already carry."""
    window = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    return (
        (rows.withWatermark("event_time", delay) if delay else rows)
        .groupBy(window.alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), *labels, "events")
    )


def drift_check(
    spark: SparkSession,
    folder: str,
    run: int,
    reference_rows: int = DRIFT_REFERENCE_ROWS,
    current_rows: int = DRIFT_CURRENT_ROWS,
    min_rows: int = DRIFT_MIN_ROWS,
) -> bool:
    """One scheduled drift check of the stored features: first against last rows. Appends
    the per-feature report and the verdict under the run number; False when there are
    too few rows."""
    features = current_features(spark, f"{folder}/transaction_features")
    if features is None:
        return False
    frame = drift_columns(features)
    reference = stored(drift_scan(frame, "reference", reference_rows))
    current = stored(drift_scan(frame, "current", current_rows))
    if not (enough_for_drift(reference, min_rows) and enough_for_drift(current, min_rows)):
        return False
    report = stored(drift_report(reference, current)).withColumn("checked_at", F.current_timestamp())
    append_batch(report, f"{folder}/drift_features", run)
    append_batch(
        drift_dataset(report).withColumn("checked_at", F.current_timestamp()), f"{folder}/drift_runs", run
    )
    return True


def set_drift_reference(reference: DataFrame, folder: str, features: Sequence[str] = tuple(DRIFT_FEATURES)) -> None:
    """Fix the bin edges of the stored summaries by a reference period, and summarise that period
    as batch -1. Feature batches are summarised on these edges from then on."""
    spark = reference.sparkSession
    frame = stored(drift_columns(reference))
    append_batch(sm.edges_table(frame, features), f"{folder}/drift_edges", 0)
    edges = sm.read_edges(read_batches(spark, f"{folder}/drift_edges"))
    append_batch(sm.summarise(frame, edges), f"{folder}/drift_summaries", -1)


def period_drift_check(
    spark: SparkSession, folder: str, run: int, reference: Column, current: Column, min_rows: int = DRIFT_MIN_ROWS
) -> bool:
    """One scheduled drift check of two periods, conditions on ``day``, from the stored summaries
    alone: its cost follows the number of days and batches, not of rows. Appends the result
    per feature under the run number; False when a period has too few rows."""
    summaries = read_batches(spark, f"{folder}/drift_summaries")
    if summaries is None:
        return False
    found = stored(sm.drift_between(summaries, reference, current))
    if found.where((F.col("reference_rows") < min_rows) | (F.col("current_rows") < min_rows)).count() or found.isEmpty():
        return False
    append_batch(found.withColumns({"run": F.lit(run), "checked_at": F.current_timestamp()}), f"{folder}/drift_period_runs", run)
    return True


def stored_drift_history(spark: SparkSession, folder: str) -> DataFrame | None:
    """Every appended run beside the last before it."""
    runs = read_batches(spark, f"{folder}/drift_period_runs")
    return None if runs is None else sm.drift_history(runs)


# --- referential check -----------------------------------------------------------------


def with_raw_events(features: DataFrame, raw: DataFrame, delay: str = "10 minutes", apart: str = "0 seconds") -> DataFrame:
    """A stream of feature rows with ``has_raw_event``, against the stream of raw events.

    A feature row that comes first waits for its raw event, and the other way round, until
    rows of its time can no longer arrive: later than the newest ones by ``delay`` on both
    streams. Then it is passed on without one, and its state is dropped on both sides.
    ``apart`` is how much the event times of the two may differ."""
    left = features.withWatermark("event_time", delay)
    right = raw.select(F.col("transaction_id").alias("_raw_id"), F.col("event_time").alias("_raw_time"))
    right = right.withWatermark("_raw_time", delay)
    span = F.expr(f"INTERVAL {apart}")
    near = (F.col("_raw_time") >= F.col("event_time") - span) & (F.col("_raw_time") <= F.col("event_time") + span)
    met = left.join(right, (F.col("transaction_id") == F.col("_raw_id")) & near, "left_outer")
    return met.withColumn("has_raw_event", F.col("_raw_id").isNotNull()).drop("_raw_id", "_raw_time")


def start_referential_check(
    features: DataFrame, raw: DataFrame, folder: str, delay: str = "10 minutes", trigger: dict | None = None
) -> StreamingQuery:
    """Keep feature rows with a raw event in ``checked_features``, late orphans in ``orphans``."""

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            append_batch(rows.where("has_raw_event").drop("has_raw_event"), f"{folder}/checked_features", batch_id)
            append_batch(rows.where("NOT has_raw_event").drop("has_raw_event"), f"{folder}/orphans", batch_id)
        finally:
            rows.unpersist()

    return _start(with_raw_events(features, raw, delay), keep, f"{folder}/_progress/referential", trigger)
