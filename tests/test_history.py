"""Hand-made histories with worked-out results, and equality of all history forms."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import history as hi
from riskloom.sources.sinks import merge_rows, overflows, stored_features
from riskloom.sources.tables import event_transactions

T0 = dt.datetime(2024, 1, 1, 12)
SCHEMA = (
    "transaction_id bigint, user_id string, event_time timestamp, amount double, channel string, "
    "country string, merchant_id string, device_id string, label boolean"
)


def txn(spark, rows):
    """Rows of (offset, amount, country, merchant, device) for one user."""
    data = [(i, "u", T0 + o, float(a), "POS", c, m, d, False) for i, (o, a, c, m, d) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def out(df, *columns):
    return [tuple(r) for r in df.orderBy("transaction_id").select(*columns).collect()]


H, US = dt.timedelta(hours=1), dt.timedelta(microseconds=1)


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_first_row(spark, order):
    f = hi.history_features(txn(spark, [(0 * H, 10, "A", "m", None)]), order=order).first()
    assert (f.user_txn_count_1h, f.user_txn_count_7d, f.user_amount_sum_24h) == (0, 0, 0.0)
    assert f.user_avg_amount_30d is None and f.amount_zscore is None and f.minutes_since_last_txn is None
    assert not f.country_change_flag and not f.device_change_flag and f.user_merchant_first_time
    assert f.unique_countries_24h == 0 and f.is_foreign_txn is None


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_small_cases(spark, order):
    run = lambda rows: hi.history_features(txn(spark, rows), order=order)
    # equal amounts: mean but neither deviation nor z-score
    equal = run([(i * H, 5, "A", "m", None) for i in range(3)])
    assert out(equal, "user_avg_amount_30d", "user_std_amount_30d", "amount_zscore")[2] == (5.0, None, None)
    # the lower window edge is inside
    edge = run([(0 * H, 1, "A", "m", None), (H, 1, "A", "m", None), (2 * H + US, 1, "A", "m", None)])
    assert out(edge, "user_txn_count_1h") == [(0,), (1,), (0,)]
    # equal times: the earlier arrival counts
    ties = run([(0 * H, 1, "A", "m", None), (0 * H, 2, "B", "n", None)])
    assert out(ties, "user_txn_count_1h", "user_amount_sum_1h", "unique_countries_24h", "country_change_flag") == [
        (0, 0.0, 0, False), (1, 1.0, 1, True)
    ]
    # a missing device overwrites the last one
    devices = run([(i * H, 1, "A", "m", d) for i, d in enumerate(["x", None, "y", "z"])])
    assert out(devices, "device_change_flag") == [(False,), (False,), (False,), (True,)]
    assert out(devices, "unique_devices_24h") == [(0,), (1,), (1,), (2,)]


def test_out_of_order_rows_follow_arrival(spark):
    rows = txn(spark, [(5 * H, 3, "A", "m", None), (0 * H, 4, "B", "m", None)])
    f = hi.history_features(rows, order="arrival")
    assert out(f, "user_txn_count_1h", "user_amount_sum_1h", "minutes_since_last_txn")[1] == (1, 3.0, -300)


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_history_is_capped(spark, order):
    rows = [(i * dt.timedelta(seconds=5), 1, "A", f"m{i}", None) for i in range(600)]
    f = hi.history_features(txn(spark, rows), order=order)
    last = out(f, "user_txn_count_1h", "user_amount_sum_24h", "unique_merchants_24h")[-1]
    assert last == (500, 500.0, 500)


def test_idle_users_are_forgotten(spark):
    rows = txn(spark, [(0 * H, 1, "A", "m", None), (200 * H, 1, "A", "m", None), (201 * H, 1, "A", "m", None)])
    assert out(hi.idle_reset(rows), "history_number", "first_since_reset") == [(1, True), (2, True), (2, False)]
    assert out(hi.history_features(rows), "user_merchant_first_time") == [(True,), (False,), (False,)]


def test_a_returning_user_starts_anew(spark):
    rows = txn(spark, [(0 * H, 2, "A", "m", "d"), (1 * H, 4, "B", "n", "e"), (170 * H, 9, "B", "n", "d"), (171 * H, 3, "A", "m", "d")])
    f = hi.features_with_expiry(rows)
    assert f.columns[:2] == ["user_id", "history_number"]
    names = ["history_number", "user_txn_count_7d", "user_avg_amount_30d", "user_merchant_first_time", "country_change_flag", "minutes_since_last_txn", "is_foreign_txn"]
    assert out(f, *names) == [
        (1, 0, None, True, False, None, None), (1, 1, None, True, True, 60, True),
        (2, 0, None, True, False, None, None), (2, 1, None, True, True, 60, True),
    ]
    kept = hi.features_with_expiry(rows, idle_days=8)
    assert out(kept, "history_number", "user_merchant_first_time")[2:] == [(1, False), (1, False)]


def test_cutting_keeps_expiring_features(spark, tables):
    t = skewed(spark, tables)
    names = ["transaction_id", "history_number", *hi.FEATURE_COLUMNS]
    whole, cut = (
        hi.features_with_expiry(t, idle_days=idle, cap=20, long_user_rows=limit, block_rows=25)
        .select(*names).toPandas().sort_values("transaction_id", ignore_index=True)
        for limit, idle in ((None, 1), (30, 1))
    )
    assert whole["history_number"].max() > 3
    pd.testing.assert_frame_equal(whole, cut)


def test_without_a_cap(spark, tables):
    rows = [(i * dt.timedelta(seconds=5), 1, "A", f"m{i}", None) for i in range(700)]
    f = hi.history_features(txn(spark, rows), cap=None)
    last = out(f, "user_txn_count_1h", "user_amount_sum_24h", "unique_merchants_24h")[-1]
    assert last == (699, 699.0, 699)
    t = skewed(spark, tables).withColumn("event_time", F.when(F.col("transaction_id") % 50 == 0, F.lit(T0)).otherwise(F.col("event_time")))
    frames = [
        hi.history_features(t, cap=None, long_user_rows=limit, block_rows=20, columns=names)
        .toPandas().sort_values("transaction_id", ignore_index=True)
        for names in (hi.FEATURE_COLUMNS, ["user_txn_count_1h", "minutes_since_last_txn"]) for limit in (None, 100)
    ]
    pd.testing.assert_frame_equal(*frames[:2])
    pd.testing.assert_frame_equal(*frames[2:])
    with pytest.raises(ValueError):
        hi.history_features(t, cap=None, order="arrival")


def test_home_country_is_the_first_to_lead(spark):
    rows = txn(spark, [(i * H, 1, c, "m", None) for i, c in enumerate("ABBAAC")])
    assert out(hi.home_countries(rows), "home_country") == [(None,), ("A",), ("A",), ("B",), ("B",), ("A",)]


def skewed(spark, tables):
    """Events with a third of all rows moved to one user."""
    t = event_transactions(spark, tables)
    return t.withColumn("user_id", F.when(F.col("transaction_id") % 3 == 0, 7).otherwise(F.col("user_id")))


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_cutting_long_users_changes_nothing(spark, tables, order):
    t = skewed(spark, tables)
    frames = [
        hi.history_features(t, order=order, cap=40, long_user_rows=limit, block_rows=45)
        .select("transaction_id", *hi.FEATURE_COLUMNS).toPandas().sort_values("transaction_id", ignore_index=True)
        for limit in (None, 100)
    ]
    pd.testing.assert_frame_equal(*frames)


def test_cutting_long_users_keeps_other_operators(spark, tables):
    t = skewed(spark, tables)
    for operator, names in (
        (hi.home_countries, ["home_country", "is_foreign_txn"]),
        (lambda d, **o: hi.idle_reset(d, idle_days=1, **o), ["history_number", "first_since_reset"]),
    ):
        whole = out(operator(t, long_user_rows=None), "transaction_id", *names)
        options = dict(long_user_rows=50, block_rows=500 if operator is hi.home_countries else 30)
        assert out(operator(t, **options), "transaction_id", *names) == whole


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_cutting_keeps_rows_without_user_country_or_merchant(spark, order):
    data = [
        (i, None if i % 3 == 0 else "u", T0 + i * H, float(i % 9), "POS", None if i % 4 == 0 else f"c{i % 3}",
         None if i % 5 == 0 else f"m{i % 4}", None, False)
        for i in range(150)
    ]
    t = spark.createDataFrame(data, SCHEMA)
    names = ["transaction_id", *hi.FEATURE_COLUMNS]
    run = lambda limit: out(hi.history_features(t, order=order, cap=20, long_user_rows=limit, block_rows=25), *names)
    whole = run(None)
    assert len(whole) == 150 and run(30) == whole
    homes = [
        out(hi.home_countries(t, long_user_rows=limit, block_rows=25 if limit is None else 500), "transaction_id", "home_country")
        for limit in (None, 30)
    ]
    assert len(homes[0]) == 150 and homes[0] == homes[1]


def test_named_columns_equal_the_whole_row(spark, tables):
    t = event_transactions(spark, tables)
    whole = out(hi.history_features(t), "transaction_id", *hi.FEATURE_COLUMNS)
    for names in (["minutes_since_last_txn"], ["user_txn_count_1h", "unique_merchants_24h"], ["amount_zscore", "is_foreign_txn"]):
        places = [hi.FEATURE_COLUMNS.index(n) + 1 for n in names]
        part = hi.history_features(t, columns=names)
        assert [c for c in part.columns if c in hi.FEATURE_COLUMNS] == [c for c in part.columns if c in names]
        assert out(part, "transaction_id", *names) == [(r[0], *[r[i] for i in places]) for r in whole]


def test_the_plan_follows_the_named_columns(spark, tables):
    t = event_transactions(spark, tables)

    def count(names, node):
        plan = hi.history_features(t, columns=names, long_user_rows=None)._jdf.queryExecution().optimizedPlan().toString()
        return sum(line.lstrip(" +-:").startswith(node) for line in plan.splitlines())

    recency = ["minutes_since_last_txn", "country_change_flag"]
    assert count(recency, "Window") == 1 and count(recency, "Generate") == 0
    assert count(["user_txn_count_1h"], "Window") == 2
    assert count(None, "Window") > 4


def brute_force(rows: pd.DataFrame, cap: int) -> dict:
    """Counts, sums and distincts by scanning each row's earlier rows."""
    found = {}
    for _, user in rows.sort_values(["us", "transaction_id"]).groupby("user_id"):
        seen = user.to_dict("records")
        for i, r in enumerate(seen):
            past = [p for p in seen[max(0, i - cap) : i]]
            day = [p for p in past if p["us"] >= r["us"] - hi.DAY_US]
            found[r["transaction_id"]] = (
                len([p for p in past if p["us"] >= r["us"] - hi.HOUR_US]), len(day),
                round(sum(p["cents"] for p in day)) / 100, len({p["merchant_id"] for p in day}),
            )
    return found


def test_against_a_plain_scan(spark, tables):
    t = skewed(spark, tables)
    want = brute_force(t.select("transaction_id", "user_id", "us", "cents", "merchant_id").toPandas(), 10)
    f = hi.history_features(t, cap=10, long_user_rows=100, block_rows=60)
    got = out(f, "transaction_id", "user_txn_count_1h", "user_txn_count_24h", "user_amount_sum_24h", "unique_merchants_24h")
    assert {r[0]: r[1:] for r in got} == want


def test_unknown_channel(spark):
    rows = txn(spark, [(0 * H, 1, "A", "m", None)]).withColumn("channel", F.lit("pos"))
    assert hi.feature_rows(rows).first()["channel_encoded"] == -1


def test_stored_types_and_overflow(spark):
    rows = spark.createDataFrame([("1", 12345.0), ("2", 3.0), ("3", None)], "transaction_id string, amount_zscore double")
    assert overflows(rows).first()[0] == 1
    assert [r[0] for r in stored_features(rows).orderBy("transaction_id").select("amount_zscore").collect()][0] is None


def test_merge_keeps_first_and_takes_newest(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 5, True, 1), ("a", 2.0, 6, False, 2), ("b", 9.0, None, None, 2)],
        "transaction_id string, amount double, user_txn_count_1h int, label boolean, version int",
    )
    assert out(merge_rows(rows, "version"), "amount", "user_txn_count_1h", "label") == [(1.0, 6, True), (9.0, None, None)]
