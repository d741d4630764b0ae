"""Monitoring queries over event tables: rates, rolling counts, lag, latency quantiles.

Each first aggregates to (window, label), so a busy minute or a frequent label is
combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import ratio_or_zero
from riskloom.operators.ordering import rank_blocks, ranked


def per_window(events: DataFrame, width: str = "1 minute", labels: Sequence[str] = (), time: str = "event_time", slide: str | None = None) -> DataFrame:
    """Events per window (tumbling, or sliding with ``slide``) and label."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        events.groupBy(window.alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), *labels, "events")
    )


def increase(events: DataFrame, width: str = "1 hour", slide: str = "5 minutes", labels: Sequence[str] = (), time: str = "event_time") -> DataFrame:
    """Events in each sliding window.

    Events are first counted per slide step; only those counts are copied into the
    windows that contain them."""
    steps = per_window(events, slide, labels, time)
    return (
        steps.groupBy(F.window("window_start", width, slide).alias("w"), *labels)
        .agg(F.sum("events").alias("events"))
        .select(F.col("w.start").alias("window_start"), *labels, "events")
    )


def decision_counts(decided: DataFrame, width: str = "1 hour", time: str = "event_time") -> DataFrame:
    """Decisions per window, one column each, with the rate per minute of all of them."""
    minutes = F.expr(f"cast(interval {width} as interval second)").cast("int") / 60
    count = lambda d: F.count_if(F.col("decision") == d)
    return (
        decided.groupBy(F.window(time, width).alias("w"))
        .agg(
            count("APPROVE").alias("approve"),
            count("REVIEW").alias("review"),
            count("BLOCK").alias("block"),
            (F.count(F.lit(1)) / minutes).alias("decisions_per_minute"),
        )
        .select(F.col("w.start").alias("window_start"), "approve", "review", "block", "decisions_per_minute")
    )


def block_rate(decided: DataFrame, width: str = "5 minutes", time: str = "event_time") -> DataFrame:
    return (
        decided.groupBy(F.window(time, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("decisions"),
            ratio_or_zero(F.count_if(F.col("decision") == "BLOCK"), F.count(F.lit(1))).alias("block_rate"),
        )
        .select(F.col("w.start").alias("window_start"), "decisions", "block_rate")
    )


def alert_counts(alerts: DataFrame, now, span: str = "24 hours") -> DataFrame:
    """Alerts per decision in the span before ``now``; every decision has a line."""
    recent = alerts.where(F.col("created_at") > now - F.expr(f"interval {span}"))
    counts = recent.agg(
        F.count_if(F.col("decision") == "REVIEW").alias("REVIEW"),
        F.count_if(F.col("decision") == "BLOCK").alias("BLOCK"),
    )
    return counts.unpivot([], ["REVIEW", "BLOCK"], "decision", "alerts")


def consumer_lag(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages behind per (topic, partition): end of the log minus committed position."""
    ends = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    places = committed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position"))
    # one row per partition on both sides
    return ends.join(places, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "end_offset",
        F.coalesce("position", F.lit(0)).cast("bigint").alias("position"),
        (F.col("end_offset") - F.coalesce("position", F.lit(0))).alias("lag"),
    )


def histogram_quantiles(
    events: DataFrame,
    seconds: str,
    bounds: Sequence[float],
    fractions: Sequence[float] = (0.5, 0.95, 0.99),
    width: str = "5 minutes",
    time: str = "event_time",
) -> DataFrame:
    """Quantiles from fixed buckets per window, by linear interpolation inside the bucket
    that holds the rank; beyond the last bound the answer is that bound."""
    counted = events.groupBy(F.window(time, width)["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("total"),
        F.array(*[F.count_if(F.col(seconds) <= b) for b in bounds]).alias("cum"),
    )
    lower = F.array(F.lit(0.0), *[F.lit(b) for b in bounds[:-1]])
    upper = F.array(*[F.lit(b) for b in bounds])
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice("cum", 1, len(bounds) - 1))
    buckets = F.arrays_zip(
        lower.alias("lower"), upper.alias("upper"), before.alias("before"), F.col("cum").alias("upto")
    )
    ranked_ = counted.withColumn("fraction", F.explode(F.array(*[F.lit(f) for f in fractions])))
    rank = F.col("fraction") * F.col("total")
    hit = F.get(F.filter(buckets, lambda b: b["upto"] >= rank), F.lit(0))
    inside = hit["lower"] + (hit["upper"] - hit["lower"]) * F.try_divide(
        rank - hit["before"], (hit["upto"] - hit["before"]).cast("double")
    )
    return ranked_.select(
        "window_start",
        "fraction",
        F.when(F.col("cum")[len(bounds) - 1] < rank, F.lit(bounds[-1])).otherwise(inside).alias("seconds"),
    )


def rolling_scores(
    scored: DataFrame, rows: int = 100, order: Sequence[str] = ("event_time", "transaction_id"), block_rows: int = 100_000
) -> DataFrame:
    """Mean and maximum of the newest ``rows`` scores at every row of the global order.

    The order is cut into blocks of consecutive rows with the needed overlap, so the
    window runs in parallel and still sees exactly the previous rows."""
    placed = rank_blocks(ranked(scored, order), block_rows, rows - 1)
    newest = Window.partitionBy("_block").orderBy("_rank").rowsBetween(-(rows - 1), 0)
    return (
        placed.withColumns({"score_mean": F.avg("score").over(newest), "score_max": F.max("score").over(newest)})
        .where("_own")
        .select(*scored.columns, "score_mean", "score_max")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", by: Sequence[str] = ("user_id",), time: str = "event_time") -> DataFrame:
    """Events per session: a session ends when none of its key's events follows within the
    gap. The same on a stream that carries a watermark."""
    session = F.session_window(time, gap)
    return (
        events.groupBy(*by, session.alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events")
    )


# --- users active in a sliding period ------------------------------------------------


def active_by_day(txn: DataFrame, days: int = 7) -> DataFrame:
    """``day, active_users``: the exact number of users with a row in the ``days`` up to each day
    of the table, that day included.

    A user stays active from a day with rows until ``days`` later, or until its next such day.
    Only the two ends of each such stretch are counted, and a running sum over the days, one
    row each, gives the users that are active: no user is copied into the days it covers."""
    seen = txn.where(F.col("user_id").isNotNull()).select(F.to_date("event_time").alias("day"), "user_id").distinct()
    later = F.lead("day").over(Window.partitionBy("user_id").orderBy("day"))
    over = F.date_add("day", days)
    # a stretch that the next one continues has no end, and that one no beginning
    ends = seen.select("day", over.alias("over"), later.alias("next"), F.lag("day").over(Window.partitionBy("user_id").orderBy("day")).alias("last"))
    opens = F.col("last").isNull() | (F.date_add("last", days) < F.col("day"))
    closes = F.col("next").isNull() | (F.col("next") > F.col("over"))
    changes = ends.select(
        F.inline(
            F.array(
                F.struct(F.col("day").alias("day"), opens.cast("long").alias("change"), F.lit(True).alias("given")),
                F.struct(F.col("over").alias("day"), (-closes.cast("long")).alias("change"), F.lit(False).alias("given")),
            )
        )
    )
    daily = changes.groupBy("day").agg(F.sum("change").alias("change"), F.bool_or("given").alias("given"))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per day
    return daily.withColumn("active_users", F.sum("change").over(so_far)).where("given").select("day", "active_users")


def daily_sketches(txn: DataFrame, precision: int = 12) -> DataFrame:
    """``day, users``: a mergeable sketch of each day's users (HyperLogLog, 2^``precision`` registers)."""
    return txn.groupBy(F.to_date("event_time").alias("day")).agg(F.hll_sketch_agg("user_id", precision).alias("users"))


def active_from_sketches(sketches: DataFrame, days: int = 7) -> DataFrame:
    """``day, active_users`` as ``active_by_day``, estimated by merging stored daily sketches; days
    may come in several rows, from batches that were sketched on their own. The relative
    standard error is about 1.04 / sqrt(2^precision)."""
    known = sketches.select("day").distinct()
    reach = sketches.select(F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("day"), "users")
    merged = reach.join(known, "day", "left_semi").groupBy("day").agg(F.hll_union_agg("users").alias("users"))
    return merged.select("day", F.hll_sketch_estimate("users").alias("active_users"))
