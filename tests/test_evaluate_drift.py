"""Evaluation, preparation, drift, explanation and model edge cases."""

import math

import numpy as np
import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import alerts as al
from riskloom.operators import drift as dr
from riskloom.operators import evaluate as ev
from riskloom.operators import models as mo
from riskloom.operators import monitor as mn
from riskloom.operators import ordering as od
from riskloom.operators import prepare as pr
from riskloom.operators import quality as qu
from riskloom.functions.explain import risk_factors
from riskloom.functions.statistics import chi2_tail, erfc, kolmogorov_tail


def scored(spark, pairs):
    return spark.createDataFrame([(i, float(s), bool(y)) for i, (s, y) in enumerate(pairs)], "transaction_id bigint, score double, label boolean")


def metrics(spark, pairs):
    return ev.curve_metrics(ev.score_counts(scored(spark, pairs))).first()


def test_perfect_constant_and_single_class(spark):
    perfect = metrics(spark, [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)])
    assert (perfect.roc_auc, perfect.pr_auc, perfect.recall_at_1pct_fpr) == (1.0, 1.0, 1.0)
    assert metrics(spark, [(0.5, 1), (0.5, 0), (0.5, 0)]).roc_auc == 0.5
    only = [(0.1 * i, 0) for i in range(10)]
    none = metrics(spark, only)
    assert none.roc_auc is None and none.recall == 0.0 and none.f1 == 0.0
    assert ev.lift(scored(spark, only)).first().lift == 0.0
    assert pr.class_balance(scored(spark, only)).first().positive_weight == 1.0


def test_areas_against_a_plain_scan(spark):
    rng = np.random.default_rng(1)
    pairs = [(round(s, 1), s + rng.normal(0, 0.4) > 0.6) for s in rng.uniform(size=300)]
    s, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    wins = (s[y][:, None] > s[~y]).mean() + 0.5 * (s[y][:, None] == s[~y]).mean()
    assert math.isclose(metrics(spark, pairs).roc_auc, wins, rel_tol=1e-12)
    best = ev.optimal_threshold(scored(spark, pairs)).first()
    rates = {t: ((s >= t) & ~y).sum() / (~y).sum() for t in set(s)}
    assert abs(best.actual_fpr - 0.05) <= min(abs(r - 0.05) for r in rates.values()) + 1e-12


def test_lift_of_few_rows_takes_all(spark):
    assert ev.lift(scored(spark, [(0.9, 1), (0.1, 0)])).first().top_rows == 2


def test_ranks_follow_the_whole_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    assert od.ranked(df.repartition(7), ["v"]).where("_rank <> v").count() == 0
    grouped = od.ranked(df, ["v"], group=["g"])
    assert grouped.groupBy("g").agg(F.max("_rank") + 1 - F.count("*")).where("`((max(_rank) + 1) - count(1))` <> 0").count() == 0
    totals = od.running_totals(df, ["v"], {"n": F.lit(1)}, following=["v"])
    assert totals.where("cum_n <> v + 1 or total_n <> 5000 or next_v <> v + 1").count() == 0


def test_positions_from_a_sampled_bracket(spark):
    # a third of all rows share one leading value
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id") * 7919 % 6000).alias("v"), "id")
    want = {r["_rank"]: (r["v"], r["id"]) for r in od.ranked(df, ["v", "id"]).where("_rank in (0, 1500, 4200, 5999)").collect()}
    for sample in (200, 1000, 10_000):
        got = od.rows_at(df, ["v", "id"], [0, 1500, 4200, 5999, 6000], 6000, sample)
        assert {p: (r["v"], r["id"]) for p, r in got.items()} == want
    only = od._rows_by_bracket(df, ["v", "id"], [1500, 4200], 6000, 1000)
    assert {p: (r["v"], r["id"]) for p, r in only.items()} == {p: want[p] for p in (1500, 4200)}


def test_positions_with_null_keys(spark):
    v = F.when(F.col("id") % 100 < 2, F.lit(None)).otherwise(F.col("id") * 7919 % 6000)
    df = spark.range(6000).select(v.alias("v"), "id")
    places = [0, 60, 119, 120, 121, 3000, 5999]
    want = {r["_rank"]: (r["v"], r["id"]) for r in od.ranked(df, ["v", "id"]).where(F.col("_rank").isin(places)).collect()}
    for sample in (300, 1000, 10_000):
        got = od.rows_at(df, ["v", "id"], places, 6000, sample)
        assert {p: (r["v"], r["id"]) for p, r in got.items()} == want
    bracket = od._rows_by_bracket(df, ["v", "id"], places, 6000, 1000)
    assert {p: (r["v"], r["id"]) for p, r in bracket.items()} == {p: want[p] for p in bracket} and 3000 in bracket


def test_text_in_a_drift_column_counts_as_zero(spark):
    df = spark.createDataFrame([(1, "12.5"), (2, "n/a"), (3, None)], "transaction_id long, hour_of_day string")
    df = df.withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    rows = pr.drift_columns(df).orderBy("transaction_id").collect()
    assert [r["hour_of_day"] for r in rows] == [12.5, 0.0, 12.0]


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 10)] + [("b", 5.0)], "g string, v double")
    got = {(r.g, r.fraction): r.quantile for r in od.exact_quantiles(df, [0.5, 0.9], ["g"], "v").collect()}
    assert got[("a", 0.5)] == 2.0 and math.isclose(got[("a", 0.9)], 7.6) and got[("b", 0.9)] == 5.0


def test_split_cuts_are_truncated(spark):
    df = spark.range(650).select(F.col("id").alias("transaction_id"), F.timestamp_seconds("id").alias("event_time"))
    sizes = {r["split"]: r["count"] for r in pr.time_split(df).groupBy("split").count().collect()}
    assert sizes == {"train": 454, "val": int(650 * 0.85) - 454, "test": 650 - int(650 * 0.85)}


def test_too_few_rows(spark, tables):
    from riskloom.operators.history import feature_rows
    from riskloom.sources.tables import event_transactions

    with pytest.raises(pr.NotEnoughRows):
        pr.labelled_scan(feature_rows(event_transactions(spark, tables)), 100_000)


def test_fingerprint_ignores_order_only(spark):
    a = spark.createDataFrame([(1, True), (2, False)], "transaction_id bigint, label boolean")
    mark = lambda df: pr.data_fingerprint(df).first().fingerprint
    assert mark(a) == mark(a.orderBy(F.desc("transaction_id"))) and len(mark(a)) == 16
    assert mark(a) != mark(a.withColumn("label", ~F.col("label"))) and mark(a) != mark(a.unionAll(a))


def test_tails(spark):
    row = spark.range(1).select(
        erfc(F.lit(0.7)).alias("e"), chi2_tail(F.lit(7.3), F.lit(3)).alias("c3"), chi2_tail(F.lit(7.3), F.lit(4)).alias("c4"),
        chi2_tail(F.lit(7.3), F.lit(1)).alias("c1"), chi2_tail(F.lit(7.3), F.lit(7)).alias("c7"), kolmogorov_tail(F.lit(1.0)).alias("k"),
    ).first()
    assert math.isclose(row.e, math.erfc(0.7), rel_tol=1e-6)
    assert math.isclose(row.c4, math.exp(-3.65) * (1 + 3.65), rel_tol=1e-9)
    assert math.isclose(row.c1, math.erfc(math.sqrt(3.65)), rel_tol=1e-6)
    half_df3 = math.erfc(math.sqrt(3.65)) + math.exp(-3.65) * math.sqrt(3.65) * 2 / math.sqrt(math.pi)
    assert math.isclose(row.c3, half_df3, rel_tol=1e-6)
    more = sum(math.exp(-3.65) * 3.65**k / math.gamma(k + 1) for k in (1.5, 2.5))
    assert math.isclose(row.c7, half_df3 + more, rel_tol=1e-6)
    assert math.isclose(row.k, 0.26999967, rel_tol=1e-6)


def gamma_tail(a, x):
    """Regularised upper incomplete gamma function by its series."""
    term = total = 1 / a
    for n in range(1, 20_000):
        term *= x / (a + n)
        total += term
    return 1 - total * math.exp(a * math.log(x) - x - math.lgamma(a))


def test_tail_of_many_degrees(spark):
    cases = [(x, df) for df in (6, 99, 100, 101, 500, 3001) for x in (0.8 * df, float(df), df + 2.5 * math.sqrt(2 * df))]
    rows = spark.createDataFrame(cases, "x double, df int").select("x", "df", chi2_tail(F.col("x"), F.col("df")).alias("p")).collect()
    assert all(math.isclose(r["p"], gamma_tail(r["df"] / 2, r["x"] / 2), abs_tol=1e-4) for r in rows)
    assert spark.range(1).select(chi2_tail(F.lit(1e6), F.lit(3001))).first()[0] == 0


def frame(spark, values, name="amount"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_psi_cases(spark):
    one = lambda r, c: dr.psi(frame(spark, r), frame(spark, c)).first().psi
    assert one(range(100), range(100)) == 0.0
    assert one([5.0] * 20, [5.0] * 7) == 0.0
    # rows outside the range leave their bin but stay in the denominator
    r, c = list(range(10)), list(range(5)) + [99] * 5
    edges = np.histogram_bin_edges(r, 10)
    rp = np.histogram(r, edges)[0] / 10
    cp = np.where(np.histogram(c, edges)[0] == 0, 0.0001, np.histogram(c, edges)[0] / 10)
    assert math.isclose(one(r, c), float(np.sum((cp - rp) * np.log(cp / rp))), rel_tol=1e-12)


def test_distances_against_a_plain_scan(spark):
    rng = np.random.default_rng(2)
    r, c = rng.normal(size=400).round(2), rng.normal(0.3, 1.2, size=150).round(2)
    row = dr.feature_tests(frame(spark, r), frame(spark, c)).first()
    grid = np.unique(np.concatenate([r, c]))
    gaps = np.abs(np.searchsorted(np.sort(r), grid, "right") / 400 - np.searchsorted(np.sort(c), grid, "right") / 150)
    assert math.isclose(row.ks_d, gaps.max(), rel_tol=1e-12)
    assert math.isclose(row.wasserstein, float(np.sum(gaps[:-1] * np.diff(grid)) / r.std()), rel_tol=1e-9)


def test_choice_of_drift_test(spark):
    pick = lambda n, k: dr.select_test(dr.feature_tests(frame(spark, [i % k for i in range(n)]), frame(spark, range(k)))).first().stattest
    assert [pick(1000, 2), pick(1000, 4), pick(1000, 9)] == ["z", "chi2", "ks"]
    assert [pick(1001, 4), pick(1001, 9)] == ["jensenshannon", "wasserstein"]


def test_no_shared_features(spark):
    with pytest.raises(dr.NoFeatures):
        dr.psi(frame(spark, [1], "x"), frame(spark, [1], "y"))


def test_decision_edges(spark):
    rows = spark.createDataFrame([(0.2999,), (0.3,), (0.6999,), (0.7,)], "score double")
    assert [r.decision for r in al.decide(rows).orderBy("score").collect()] == ["APPROVE", "REVIEW", "REVIEW", "BLOCK"]


def quiet_row(spark, **given):
    row = pr.scoring_input(spark.sql("SELECT 'a' AS transaction_id, timestamp '2024-01-02 10:00:00' AS event_time, 10.0 AS amount, 'web' AS channel"))
    return row.withColumns({k: F.lit(v) for k, v in given.items()})


def test_risk_factors(spark):
    pick = lambda row, score: row.select(risk_factors(F.lit(score)).alias("f")).first().f
    assert pick(quiet_row(spark), 0.5) == ["Multiple moderate risk factors combined"]
    assert pick(quiet_row(spark), 0.3) == []
    loud = quiet_row(spark, amount=2500.5, amount_zscore=3.26, minutes_since_last_txn=2)
    assert pick(loud, 0.1) == [
        "High transaction amount ($2,500.50)",
        "Amount is unusually high for this user (3.3 std devs)",
        "Rapid transaction (2 minutes since last)",
    ]


def test_unknown_channel_scores_as_pos(spark):
    assert quiet_row(spark).first().channel_encoded == 0


def test_contributions(spark):
    row = quiet_row(spark, amount=5000.0, is_night=1)
    top = al.explain(row.withColumn("score", F.lit(0.8)), {"amount": 0.5, "is_night": 0.4, "day_of_week": 0.1}, top_k=2)
    got = [(c.feature, c.contribution) for c in top.first().top_features]
    assert got == [("amount", 0.5), ("is_night", 0.004)]


def test_request_checks_and_budget(spark):
    rows = spark.createDataFrame([("a", "u", 1.0, "POS", "A", "m"), ("b", "u", -1.0, None, "A", "m")], "transaction_id string, user_id string, amount double, channel string, country string, merchant_id string")
    good, bad = qu.split_requests(rows)
    assert good.count() == 1 and bad.first().reasons == ["missing_channel", "amount_not_positive"]
    assert qu.within_error_budget(bad, 1) and not qu.within_error_budget(bad, 0)


def test_rolling_scores_cross_blocks(spark):
    rows = spark.range(300).select(F.col("id").alias("transaction_id"), F.timestamp_seconds("id").alias("event_time"), (F.col("id") % 10).cast("double").alias("score"))
    small = mn.rolling_scores(rows, rows=20, block_rows=25).orderBy("transaction_id").toPandas()
    want = rows.toPandas().score.rolling(20, min_periods=1)
    assert np.allclose(small.score_mean, want.mean()) and (small.score_max == want.max()).all()


def test_forest_finds_the_far_point(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(400, 2)), [[9.0, 9.0]]])
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "transaction_id bigint, a double, b double")
    forest = mo.train_isolation_forest(rows, ["a", "b"], trees=40)
    found = mo.anomaly_scores(forest, rows)
    assert found.orderBy(F.desc("anomaly_score")).first().transaction_id == 400
    flagged = mo.is_anomaly(found, 0.02).where("is_anomaly").count()
    assert 1 <= flagged <= 9


def test_model_round_trip(spark, tmp_path):
    from riskloom.sources.sinks import save_model, write_importance

    rows = spark.range(400).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 100).cast("double").alias("amount"), (F.col("id") % 7).cast("double").alias("hour_of_day"),
        (F.col("id") % 100 > 80).cast("int").alias("label"), F.when(F.col("id") < 300, "train").otherwise("val").alias("split"),
    )
    model = mo.train_classifier(rows, params={"maxIter": 5})
    save_model(model, str(tmp_path), "classifier", 1)
    loaded = mo.load_model(str(tmp_path), "classifier", 1)
    both = [[r.score for r in mo.score(m, rows).orderBy("transaction_id").collect()] for m in (model, loaded)]
    assert both[0] == both[1] and both[0][90] > 0.5 > both[0][10]
    importance = mo.feature_importance(model)
    assert importance.first().feature == "amount"
    write_importance(importance, str(tmp_path / "importance"))
    assert spark.read.csv(str(tmp_path / "importance"), header=True).count() == 2
    # a column the rows lack counts as 0
    assert mo.score(model, rows.drop("hour_of_day")).count() == 400


def test_order_hash_follows_the_order_alone(spark):
    from riskloom.operators.prepare import order_hash

    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k // 3), k % 5 == 0 if k % 7 else None) for k in range(200)]
    shape = "transaction_id long, event_time timestamp, label boolean"
    of = lambda data, parts=3, **o: tuple(order_hash(spark.createDataFrame(data, shape).repartition(parts), **o).first())
    first = of(rows, fanout=4)
    assert first[0] == 200 and of(rows[::-1], 7, fanout=4) == first
    swapped = [*rows]
    swapped[10], swapped[20] = (rows[20][0], *rows[10][1:]), (rows[10][0], *rows[20][1:])
    dropped, flipped = rows[:-1], [*rows[:-1], (199, rows[199][1], not rows[199][2])]
    assert len({first, of(swapped, fanout=4), of(dropped, fanout=4), of(flipped, fanout=4), of(rows[:0])}) == 5


def test_sketches_of_days_merge(spark):
    from riskloom.operators import monitor as mn

    rows = spark.range(60_000).selectExpr(
        "id % 20000 AS user_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(pmod(hash(id), 40) AS int)) AS event_time"
    ).where("day(event_time) % 4 <> 0")  # days without rows
    exact = {r["day"]: r["active_users"] for r in mn.active_by_day(rows).collect()}
    halves = [mn.daily_sketches(rows.where(f"user_id % 2 = {k}")) for k in (0, 1)]
    found = {r["day"]: r["active_users"] for r in mn.active_from_sketches(halves[0].unionByName(halves[1])).collect()}
    assert set(found) == set(exact) and len(exact) > 20
    assert all(abs(found[d] - n) <= 4 * 1.04 / 64 * n for d, n in exact.items())
    brute = {}
    seen = {(r[0], r[1]) for r in rows.selectExpr("to_date(event_time)", "user_id").collect()}
    for day in exact:
        brute[day] = len({u for d, u in seen if 0 <= (day - d).days < 7})
    assert brute == exact
