"""Stream jobs give what the batch operators give, also when files or batches repeat."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import summaries as sm
from riskloom.operators.drift import simple_drift

from riskloom.operators.history import FEATURE_COLUMNS, feature_rows, features_with_expiry, history_features
from riskloom.operators.prepare import drift_period
from riskloom.sources import messages as ms
from riskloom.sources import sinks
from riskloom.sources.tables import event_transactions
from riskloom.streaming import jobs, stateful


@pytest.fixture(scope="module")
def landed(spark, tables, tmp_path_factory):
    """Events as three message files, oldest first, and a copy of the second."""
    folder = tmp_path_factory.mktemp("landed")
    sent = ms.messages_from(event_transactions(spark, tables))
    for i in range(3):
        part = sent.where((F.col("offset") >= i * 334) & (F.col("offset") < (i + 1) * 334))
        part.coalesce(1).write.mode("append").json(str(folder / "in"))
    return str(folder / "in"), sent


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_ingest_is_repeatable(spark, landed, tmp_path):
    source, sent = landed
    out = str(tmp_path)
    for _ in range(2):
        jobs.start_ingest(ms.file_messages(spark, source), out).awaitTermination()
    raw = sinks.read_batches(spark, f"{out}/raw_events")
    assert raw.count() == sent.count()
    # the same messages again, as a new batch, and one known id under a new offset
    again = sent.where("offset < 50").unionAll(sent.where("offset = 7").withColumn("offset", F.lit(10**9)))
    jobs.ingest_batch(again, 99, out)
    assert sinks.read_batches(spark, f"{out}/raw_events").count() == sent.count()
    assert sinks.read_batches(spark, f"{out}/rejects").count() == 1


def test_bad_messages_are_quarantined(spark, landed, tmp_path):
    _, sent = landed
    bad = sent.limit(3).withColumn("value", F.lit('{"transaction_id": "x"'))
    jobs.ingest_batch(sent.limit(10).unionAll(bad), 0, str(tmp_path))
    assert sinks.read_batches(spark, f"{tmp_path}/quarantine").count() == 3
    # the batch that spends the budget is stored; the next one of the run stops, a new run goes on
    with pytest.raises(jobs.ErrorBudgetSpent):
        jobs.ingest_batch(bad, 1, str(tmp_path), error_budget=2, since=0)
    assert sinks.read_batches(spark, f"{tmp_path}/quarantine").count() == 3
    jobs.ingest_batch(bad, 1, str(tmp_path), error_budget=2, since=1)
    assert sinks.read_batches(spark, f"{tmp_path}/quarantine").count() == 6


def test_ids_are_unique_over_dates(spark, landed, tmp_path):
    _, sent = landed
    out = str(tmp_path)
    jobs.ingest_batch(sent.limit(0), 0, out)  # an empty first batch leaves tables that can be read
    jobs.ingest_batch(sent.where("offset < 50"), 1, out)
    later = F.regexp_replace("value", '"timestamp":"2024-01', '"timestamp":"2024-03')
    moved = sent.where("offset = 7").withColumn("value", later).withColumn("offset", F.lit(10**9))
    jobs.ingest_batch(moved, 2, out)
    assert sinks.read_batches(spark, f"{out}/raw_events").count() == 50
    assert sinks.read_batches(spark, f"{out}/rejects").count() == 1
    assert sinks.read_batches(spark, f"{out}/nothing") is None


def test_only_touched_buckets_are_read(spark, landed, tmp_path):
    _, sent = landed
    good = ms.good_rows(ms.parse_messages(sent))
    sinks.append_bucketed(good, f"{tmp_path}/t", 0, "user_id")
    user = good.select("user_id").first()[0]
    one = good.where(F.col("user_id") == user)
    found = sinks.read_buckets(spark, f"{tmp_path}/t", one, "user_id", before=1)
    assert found.where(F.col("user_id") == user).count() == one.count()
    assert found.select(F.input_file_name()).distinct().count() == 1
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_stream_features_equal_batch(spark, landed, tables, tmp_path):
    source, _ = landed
    out = str(tmp_path)
    jobs.start_features(ms.file_messages(spark, source), out).awaitTermination()
    stream = sinks.current_features(spark, f"{out}/transaction_features")
    batch = sinks.stored_features(feature_rows(event_transactions(spark, tables)))
    names = ["transaction_id", *FEATURE_COLUMNS, "hour_of_day", "channel_encoded"]
    assert rows_of(stream, *names) == rows_of(batch, *names)
    # a replayed file changes nothing
    before = rows_of(stream, *names)
    jobs.features_batch(spark.read.schema(ms.ENVELOPE).json(source).where("offset < 334"), 50, out)
    after = sinks.current_features(spark, f"{out}/transaction_features")
    assert rows_of(after, *names) == before


@pytest.mark.parametrize("idle_days", [None, 1])
def test_keyed_state_equals_batch(spark, landed, tables, tmp_path, idle_days):
    source, _ = landed
    parsed = ms.good_rows(ms.parse_messages(ms.file_messages(spark, source, 1)))  # several micro-batches
    rows = parsed.select(
        "transaction_id", "user_id", F.unix_micros("event_time").alias("event_us"),
        F.round(F.col("amount") * 100).cast("bigint").alias("cents"), "country", "merchant_id", "device_id",
        F.col("kafka_offset").alias("arrival_order"),
    )
    name = f"keyed_{idle_days or 0}"
    query = (
        stateful.stateful_features(rows, idle_days=idle_days)
        .writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    txn = event_transactions(spark, tables)
    batch = features_with_expiry(txn, idle_days=1) if idle_days else history_features(txn)
    names = [F.col("transaction_id").cast("string"), *FEATURE_COLUMNS, *(["history_number"] if idle_days else [])]
    assert rows_of(spark.table(name), *names) == rows_of(batch, *names)


def test_array_form_equals_row_by_row():
    draw = np.random.default_rng(5)
    n, cap = 700, 60
    pick = lambda values: np.array([values[k] for k in draw.integers(0, len(values), n)], object)
    rows = {
        "us": np.cumsum(draw.integers(-10, 400, n)) * 60_000_000, "cents": draw.integers(0, 10**12, n),
        "country": pick(["A", "B", None]), "merchant": pick([f"m{k}" for k in range(30)]), "device": pick(["x", "y", None]),
    }
    none = {k: v[:0] for k, v in rows.items()}
    whole = stateful.look_back(none, rows, cap)
    split = [stateful.look_back({k: v[:a] for k, v in rows.items()}, {k: v[a:b] for k, v in rows.items()}, cap) for a, b in ((0, 300), (300, n))]
    assert all(whole[k] == split[0][k] + split[1][k] for k in whole)
    for i in range(0, n, 37):
        past = [j for j in range(max(0, i - cap), i)]
        day = [j for j in past if rows["us"][j] >= rows["us"][i] - 86_400_000_000]
        assert whole["user_txn_count_24h"][i] == len(day)
        assert whole["user_amount_sum_24h"][i] == sum(int(rows["cents"][j]) for j in day) / 100
        for name, column in (("unique_countries_24h", "country"), ("unique_devices_24h", "device")):
            assert whole[name][i] == len({rows[column][j] for j in day} - {None})
        month = [int(rows["cents"][j]) for j in past if rows["us"][j] >= rows["us"][i] - 30 * 86_400_000_000]
        if len(month) > 1:
            assert whole["user_std_amount_30d"][i] == pytest.approx(float(np.std(month)) / 100, rel=1e-9, abs=0.01)
    codes = draw.integers(0, 3, 200)
    before, _, best = stateful.leaders(codes, np.zeros(3, np.int64), -1, 0)
    lead, counts = -1, [0, 0, 0]
    for k, code in enumerate(codes):
        assert before[k] == lead
        counts[code] += 1
        lead = code if counts[code] > (counts[lead] if lead >= 0 else 0) or lead == code else lead
    assert best == max(counts)


def test_live_counts_close_windows(spark, landed, tmp_path):
    source, _ = landed
    rows = ms.good_rows(ms.parse_messages(ms.file_messages(spark, source)))
    counts = jobs.live_counts(jobs.without_repeats(rows).select("event_time", "channel"), "1 day", None, ["channel"])
    query = (
        counts.writeStream.format("memory").queryName("live").outputMode("append")
        .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = {(r[0], r[1]): r[2] for r in spark.table("live").collect()}
    want = {
        (r[0], r[1]): r[2]
        for r in spark.read.schema(ms.ENVELOPE).json(source).transform(ms.parse_messages)
        .groupBy(F.window("event_time", "1 day")["start"].alias("w"), "channel").count().collect()
    }
    assert closed and all(want[k] == v for k, v in closed.items())


def test_drift_check_appends_runs(spark, landed, tmp_path):
    source, _ = landed
    out = str(tmp_path)
    jobs.start_features(ms.file_messages(spark, source, 3), out, order="time").awaitTermination()
    assert jobs.drift_check(spark, out, 1, 600, 300)
    assert not jobs.drift_check(spark, out, 2, 600, 300, min_rows=5000)
    assert sinks.read_batches(spark, f"{out}/drift_features").count() == 10
    assert sinks.read_batches(spark, f"{out}/drift_runs").count() == 1


def test_drift_checks_read_summaries_only(spark, landed, tables, tmp_path):
    source, _ = landed
    out = str(tmp_path)
    every = feature_rows(event_transactions(spark, tables))
    cut = F.lit("2024-01-16").cast("date")
    jobs.set_drift_reference(every.where(F.col("event_time") < F.lit("2024-01-08")), out)
    stale = sinks.read_batches(spark, f"{out}/drift_summaries").count()
    jobs.start_features(ms.file_messages(spark, source, 1), out, order="time").awaitTermination()
    batches = sinks.read_batches(spark, f"{out}/drift_summaries")
    assert stale == 70 and batches.select("batch_id").distinct().count() >= 3
    fresh = batches.where("batch_id >= 0")
    by_rows = simple_drift(
        drift_period(every, before=F.lit("2024-01-08").cast("timestamp")), drift_period(every, since=F.lit("2024-01-16").cast("timestamp"))
    ).toPandas().set_index("feature").sort_index()
    merged = sm.drift_between(fresh, F.col("day") < F.lit("2024-01-08").cast("date"), F.col("day") >= cut)
    merged = merged.toPandas().set_index("feature").sort_index()
    for name in ("reference_mean", "current_mean", "reference_std", "current_std", "psi"):
        assert merged[name].tolist() == pytest.approx(by_rows[name].tolist(), abs=1e-9)
    early = F.col("day") < F.lit("2024-01-08").cast("date")
    for run, start in enumerate(("2024-01-10", "2024-01-16", "2024-01-22")):
        assert jobs.period_drift_check(spark, out, run, early, F.col("day") >= F.lit(start).cast("date"))
    assert not jobs.period_drift_check(spark, out, 9, early, F.col("day") > F.lit("2025-01-01").cast("date"))
    history = jobs.stored_drift_history(spark, out).where("feature = 'amount'").orderBy("run").collect()
    assert [r["previous_run"] for r in history] == [None, 0, 1]


def test_a_run_is_compared_with_the_last_before_it(spark):
    flags = {"a": [0, 1, 1, 0, 1], "b": [0, 0, 0, 0, 0], "c": [1, None, 1, 1, 1]}
    rows = [(run, f, run / 10, bool(flag)) for f, marks in flags.items() for run, flag in enumerate(marks) if flag is not None]
    runs = spark.createDataFrame(rows, "run int, feature string, psi double, drift_detected boolean")
    found = {(r["feature"], r["run"]): r for r in sm.drift_history(runs).collect()}
    lengths = {k: (r["drifting_since"], r["drifting_runs"], r["first_drift"], r["drift_started"]) for k, r in found.items()}
    assert [lengths["a", r] for r in range(5)] == [
        (None, None, None, False), (1, 1, 1, True), (1, 2, 1, False), (None, None, 1, False), (4, 1, 1, True),
    ]
    assert lengths["b", 4] == (None, None, None, False)
    assert lengths["c", 2] == (0, 2, 0, False) and found["c", 2]["previous_run"] == 0
    assert found["c", 2]["score_change"] == pytest.approx(0.2)


def test_features_wait_for_their_raw_events(spark, tmp_path):
    shape = "transaction_id string, event_time timestamp"
    out, arrived = str(tmp_path / "out"), {"features": 0, "raw": 0}

    def arrive(table, *rows):
        arrived[table] += 1
        data = [(i, dt.datetime(2024, 1, 1, 0, minute)) for i, minute in rows]
        spark.createDataFrame(data, shape).coalesce(1).write.parquet(f"{tmp_path}/{table}/{arrived[table]}")

    def run():
        read = lambda t: spark.readStream.schema(shape).parquet(f"{tmp_path}/{t}/*")
        jobs.start_referential_check(read("features"), read("raw"), out, "10 minutes").awaitTermination()

    def ids(table):
        return sorted(r[0] for r in sinks.read_batches(spark, f"{out}/{table}").select("transaction_id").collect())

    arrive("features", ("first", 1), ("orphan", 2))
    arrive("raw", ("later", 3))
    run()
    arrive("raw", ("first", 1))
    arrive("features", ("later", 3))
    run()
    assert ids("checked_features") == ["first", "later"] and ids("orphans") == []
    arrive("features", ("new", 40))
    arrive("raw", ("new", 40))
    run()
    arrive("features", ("newer", 41))  # the watermark of the batch before lets the orphan go
    arrive("raw", ("newer", 41))
    run()
    assert ids("checked_features") == ["first", "later", "new", "newer"] and ids("orphans") == ["orphan"]
