"""Registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import DRIFT_FEATURES, MODEL_FEATURES, SCORING_BUCKETS
from riskloom.functions import columns as cx
from riskloom.operators import alerts as al
from riskloom.operators import drift as dr
from riskloom.operators import evaluate as ev
from riskloom.operators import history as hi
from riskloom.operators import models as mo
from riskloom.operators import monitor as mn
from riskloom.operators import prepare as pr
from riskloom.operators import quality as qu
from riskloom.operators import summaries as sm
from riskloom.session import stored
from riskloom.sources import messages as ms
from riskloom.sources import sinks
from riskloom.sources.tables import event_transactions, order_transactions

Query = Callable[[SparkSession, str], DataFrame]

# importances that stand in for a model, falling in column order
IMPORTANCES = {n: (len(MODEL_FEATURES) - i) / 190 for i, n in enumerate(MODEL_FEATURES)}

_registry: dict[str, Query] = {}


def query(f: Query) -> Query:
    _registry[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(f) for name, f in _registry.items()}


def _in_utc(f: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, folder)

    return run


def _txn(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions(spark, folder)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return hi.feature_rows(_txn(spark, folder).drop("k", "home", "us", "cents"))


def _text(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def _at(df: DataFrame, name: str = "window_start") -> DataFrame:
    return df.withColumn(name, _text(name))


# --- sources and sinks -----------------------------------------------------------


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return ms.parse_messages(ms.messages_from(_txn(spark, folder)))


@query
def raw_projection(spark, folder):
    return ms.good_rows(_parsed(spark, folder)).select(
        *ms.OFFSET,
        "transaction_id", "user_id", "card_id", "merchant_id",
        F.col("amount").cast("double").alias("amount"),
        "currency",
        F.unix_micros("event_time").alias("event_us"),
        F.unix_micros("ingestion_time").alias("ingestion_us"),
        "channel", "country", "city", "device_id", "ip_hash", "label",
        (F.length("payload") > 2).alias("has_payload"),
    )


@query
def raw_dedup(spark, folder):
    """Every message, every tenth delivered twice, every seventeenth sent again later."""
    sent = ms.messages_from(_txn(spark, folder))
    n = F.col("offset")
    again = sent.where(n % 10 == 0)
    resent = sent.where(n % 17 == 0).withColumn("offset", n + 1_000_000_000)
    rows = stored(ms.good_rows(ms.parse_messages(sent.unionAll(again).unionAll(resent))).drop("payload"))
    accepted, rejected = ms.accept_new(rows)
    keep = ["transaction_id", "kafka_partition", "kafka_offset"]
    return accepted.select(*keep, F.lit("stored").alias("outcome")).unionAll(
        rejected.select(*keep, F.lit("rejected").alias("outcome"))
    )


@query
def feature_upsert(spark, folder):
    """A second version of every third row, and every fifth row only in the second."""
    f = stored(
        _features(spark, folder).select(
            "transaction_id", "amount", "label", "user_txn_count_24h", "amount_zscore", "country_change_flag"
        )
    )
    n = F.col("transaction_id")
    old = f.where(n % 5 != 1).withColumn("version", F.lit(1))
    new = f.where((n % 5 == 1) | (n % 3 == 0)).select(
        "transaction_id",
        (F.col("amount") + 1).alias("amount"),
        (~F.col("label")).alias("label"),
        (F.col("user_txn_count_24h") + 100).alias("user_txn_count_24h"),
        F.col("amount_zscore"),
        (~F.col("country_change_flag")).alias("country_change_flag"),
        F.lit(2).alias("version"),
    )
    return sinks.merge_rows(old.unionByName(new), "version")


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """All messages, some damaged in five ways chosen by the payload's own number."""
    txn = _txn(spark, folder)
    k = F.col("k") % 20
    value = (
        F.when(k == 3, F.expr("substring(value, 1, length(value) - 5)"))
        .when(k == 7, F.regexp_replace("value", '"amount":[^,]*,', ""))
        .when(k == 9, F.regexp_replace("value", '"amount":[^,]*,', '"amount":"many",'))
        .when(k == 11, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .when(k == 13, F.regexp_replace("value", '"amount":', '"amount":-'))
        .otherwise(F.col("value"))
    )
    sent = ms.messages_from(txn).withColumn("k", F.regexp_extract("value", '"merchant_id":"(\\d+)"', 1).cast("int"))
    return sent.withColumn("value", value).drop("k")


def _rejected(spark: SparkSession, folder: str) -> DataFrame:
    parsed = ms.parse_messages(_damaged(spark, folder))
    whole = F.size("reasons") == 0
    return parsed.withColumn(
        "reasons", F.when(whole, qu.request_reasons()).otherwise(F.col("reasons"))
    ).where(F.size("reasons") > 0)


@query
def quarantine(spark, folder):
    return _rejected(spark, folder).select("kafka_partition", "kafka_offset", F.explode("reasons").alias("reason"))


@query
def quarantine_stats(spark, folder):
    return qu.reason_counts(_rejected(spark, folder), "kafka_partition")


def _alert_table(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts on the stand-in score, with resolutions chosen by the payload's number."""
    k = F.col("k") % 5
    resolution = (
        F.when(k == 1, "CONFIRMED_FRAUD").when(k == 2, "FALSE_POSITIVE").when(k == 3, "PENDING").when(k == 4, "UNKNOWN")
    )
    txn = _txn(spark, folder).withColumn("resolution", resolution).withColumn("top_features", F.array().cast("array<string>"))
    return al.new_alerts(al.decide(txn), "stand-in", "1", created_at=F.col("event_time"))


@query
def constraint_violations(spark, folder):
    return qu.violations(_alert_table(spark, folder), qu.alert_rules())


@query
def required_violations(spark, folder):
    """NULLs in required columns of the raw and the feature table (some events carry no device)."""
    raw = ms.good_rows(_parsed(spark, folder))
    features = sinks.stored_features(_features(spark, folder))
    found = [
        qu.violations(t, qu.required_rules(c)).withColumn("table_name", F.lit(n))
        for n, t, c in (
            ("raw_events", raw, [*qu.RAW_REQUIRED, "device_id"]),
            ("transaction_features", features, [*qu.FEATURE_REQUIRED, "amount_zscore"]),
        )
    ]
    return found[0].unionByName(found[1])


# --- columns ---------------------------------------------------------------------


@query
def time_channel(spark, folder):
    return _txn(spark, folder).select(
        "transaction_id",
        *[c.alias(n) for n, c in cx.calendar_columns(F.col("event_time")).items()],
        cx.channel_code(F.col("channel")).alias("channel_encoded"),
        cx.channel_code_for_scoring(F.lower(F.col("channel"))).alias("scoring_channel_encoded"),
    )


@query
def rule_risk(spark, folder):
    """Amounts are scaled so that every amount rule is met by some rows."""
    return _txn(spark, folder).select(
        "transaction_id",
        F.floor(
            cx.rule_risk(F.col("amount") * 20, F.col("channel"), F.col("country"), F.col("home")) * 1e6 + 0.5
        ).alias("risk_ppm"),
    )


@query
def decisions(spark, folder):
    return al.decide(_txn(spark, folder)).select("transaction_id", "score", "decision")


# --- history -----------------------------------------------------------------------


@query
def features_full(spark, folder):
    return _features(spark, folder).drop("event_time", "latency_ms", "score", "merchant_id", "device_id")


def _part(names: Sequence[str]) -> Query:
    def run(spark, folder):
        txn = _txn(spark, folder).select(*HISTORY_INPUT)
        return hi.history_features(txn, columns=names).select("transaction_id", *names)

    return run


HISTORY_INPUT = ["transaction_id", "user_id", "event_time", "amount", "country", "merchant_id", "device_id"]
_registry["velocity"] = _part(
    ["user_txn_count_1h", "user_txn_count_24h", "user_txn_count_7d", "user_amount_sum_1h", "user_amount_sum_24h"]
)
_registry["amount_stats"] = _part(["user_avg_amount_30d", "user_std_amount_30d", "amount_zscore"])
_registry["behaviour"] = _part(
    [
        "country_change_flag", "device_change_flag", "unique_countries_24h",
        "unique_merchants_24h", "unique_devices_24h", "user_merchant_first_time",
    ]
)
_registry["recency"] = _part(["minutes_since_last_txn"])


@query
def home_country(spark, folder):
    return hi.home_countries(_txn(spark, folder)).select("transaction_id", "home_country", "is_foreign_txn")


@query
def history_exact(spark, folder):
    txn = _txn(spark, folder).drop("k", "home", "us", "cents")
    return hi.history_features(txn, order="arrival").select("transaction_id", *hi.FEATURE_COLUMNS)


@query
def history_with_ties(spark, folder):
    """Orders carry dates only, so users have rows at equal times."""
    return hi.history_features(order_transactions(spark, folder)).select(
        "transaction_id",
        "user_txn_count_24h",
        "user_txn_count_7d",
        "user_amount_sum_24h",
        "user_avg_amount_30d",
        "user_std_amount_30d",
        "unique_merchants_24h",
        "user_merchant_first_time",
        "minutes_since_last_txn",
    )


@query
def idle_reset(spark, folder):
    """On orders: sparse users who often pause for more than a week."""
    return hi.idle_reset(order_transactions(spark, folder)).select(
        "transaction_id", "history_number", "first_since_reset"
    )


EXPIRY_COLUMNS = [
    "transaction_id", "history_number", "user_txn_count_24h", "user_txn_count_7d", "user_amount_sum_24h",
    "user_avg_amount_30d", "user_std_amount_30d", "unique_merchants_24h", "user_merchant_first_time",
    "minutes_since_last_txn", "is_foreign_txn",
]


@query
def features_with_expiry(spark, folder):
    """On orders: users are forgotten after a week without a row, with all their look-backs."""
    return hi.features_with_expiry(order_transactions(spark, folder)).select(*EXPIRY_COLUMNS)


@query
def features_with_expiry_daily(spark, folder):
    """On events, where most users pause for a day now and then."""
    found = hi.features_with_expiry(_txn(spark, folder).select(*HISTORY_INPUT, "channel"), idle_days=1)
    return found.select("transaction_id", "history_number", *hi.FEATURE_COLUMNS)


@query
def features_uncapped(spark, folder):
    """Every look-back over all rows of its window, however many."""
    txn = _txn(spark, folder).select(*HISTORY_INPUT)
    return hi.history_features(txn, cap=None).select("transaction_id", *hi.FEATURE_COLUMNS)


@query
def active_users(spark, folder):
    return hi.active_users(_txn(spark, folder), max_users=10, evict=5)


@query
def active_users_by_day(spark, folder):
    daily = mn.active_by_day(_txn(spark, folder))
    return daily.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def customers_by_day(spark, folder):
    """On orders: few customers order twice within thirty days."""
    daily = mn.active_by_day(order_transactions(spark, folder), days=30)
    return daily.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def rolling_scores(spark, folder):
    rolled = mn.rolling_scores(_txn(spark, folder).select("transaction_id", "event_time", "score"))
    return rolled.select("transaction_id", cx.half_up(F.col("score_mean"), 9).alias("score_mean"), "score_max")


# --- training frames ----------------------------------------------------------------


@query
def labelled_scan(spark, folder):
    rows = pr.labelled_scan(_features(spark, folder), min_rows=500)
    return rows.withColumn("event_us", F.unix_micros("event_time")).drop("event_time")


@query
def scoring_defaults(spark, folder):
    """Raw transactions without history features: every default applies."""
    rows = _txn(spark, folder).select("transaction_id", "event_time", "amount", "channel")
    return pr.scoring_input(rows).drop("event_time", "channel")


@query
def score_input(spark, folder):
    """Features exist for labelled rows only; the others get the defaults."""
    txn = _txn(spark, folder).select("transaction_id", "event_time", "amount", "channel")
    known = _features(spark, folder).where(F.col("label").isNotNull())
    return pr.score_input(txn, known).drop("event_time", "channel")


def _split(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = _txn(spark, folder).where(F.col("label").isNotNull())
    return pr.time_split(rows.select("transaction_id", "event_time", "label", *columns))


@query
def time_split(spark, folder):
    return _split(spark, folder).select("transaction_id", "split")


@query
def split_stats(spark, folder):
    return _times(pr.split_stats(_split(spark, folder)))


def _times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.unix_micros(c) for c in ("first_time", "last_time")})


@query
def dataset_stats(spark, folder):
    rows = _txn(spark, folder).where(F.col("label").isNotNull())
    return _times(pr.dataset_stats(rows))


@query
def data_stats(spark, folder):
    return pr.data_stats(_txn(spark, folder))


@query
def class_balance(spark, folder):
    return pr.class_balance(_txn(spark, folder))


@query
def data_fingerprint(spark, folder):
    return pr.data_fingerprint(_txn(spark, folder).where(F.col("label").isNotNull()))


@query
def data_order_hash(spark, folder):
    return pr.order_hash(_txn(spark, folder).where(F.col("label").isNotNull()))


def _split_features(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled feature rows, stored once, with their split."""
    return _with_split(stored(_features(spark, folder).where(F.col("label").isNotNull())))


def _with_split(features: DataFrame) -> DataFrame:
    rows = features.where(F.col("label").isNotNull())
    return pr.time_split(rows.drop("score", "latency_ms", "merchant_id", "device_id"))


@query
def prepared_features(spark, folder):
    return pr.prepared_features(_split_features(spark, folder))


# --- evaluation ------------------------------------------------------------------------


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return _txn(spark, folder).select("transaction_id", "event_time", "label", "score")


@query
def confusion(spark, folder):
    return ev.confusion(_scored(spark, folder), 0.5)


@query
def pr_curve(spark, folder):
    return ev.pr_curve(_scored(spark, folder))


@query
def roc_curve(spark, folder):
    points = ev.roc_curve(_scored(spark, folder))
    return points.withColumn("threshold", F.when(F.col("threshold") < 10, F.col("threshold")))


@query
def roc_curve_all_points(spark, folder):
    points = ev.roc_curve(_scored(spark, folder), drop_intermediate=False)
    return points.withColumn("threshold", F.when(F.col("threshold") < 10, F.col("threshold")))


def _metrics(names: Sequence[str]) -> Query:
    def run(spark, folder):
        return ev.curve_metrics(ev.score_counts(_scored(spark, folder))).select(
            *[cx.half_up(F.col(n), 9).alias(n) for n in names]
        )

    return run


_registry["pr_auc"] = _metrics(["pr_auc"])
_registry["roc_auc"] = _metrics(["roc_auc"])
_registry["recall_at_fpr"] = _metrics(["recall_at_1pct_fpr", "recall_at_5pct_fpr", "recall_at_10pct_fpr"])


@query
def optimal_threshold(spark, folder):
    return ev.optimal_threshold(_scored(spark, folder)).select(
        "optimal_threshold", "actual_fpr", "actual_tpr", "precision", "recall", "f1", "true_positives", "false_positives"
    )


@query
def lift(spark, folder):
    return ev.lift(_scored(spark, folder))


@query
def evaluation_report(spark, folder):
    report = ev.evaluation_report(_split(spark, folder, "score"))
    return report.withColumn("value", cx.half_up(F.col("value"), 9))


@query
def promotion_gate(spark, folder):
    """The gate for every split."""
    counts = ev.score_counts(_split(spark, folder, "score"), ["split"])
    metrics = ev.curve_metrics(counts, ["split"])
    return ev.promotion_gate(metrics, min_pr_auc=0.9, min_recall=0.4).select("split", "promoted", "reason")


@query
def score_norm(spark, folder):
    return ev.normalised(_scored(spark, folder)).select("transaction_id", "score_norm")


# --- explanations and alerts --------------------------------------------------------------


def _explained(spark: SparkSession, folder: str) -> DataFrame:
    rows = pr.scoring_input(_features(spark, folder))
    return al.explain(al.decide(rows), IMPORTANCES)


# outer explodes below: a plain one makes Spark test the array for rows first, which
# evaluates the whole explanation twice


@query
def top_features(spark, folder):
    rows = _explained(spark, folder)
    return rows.select("transaction_id", F.posexplode_outer("top_features").alias("rank", "f")).select(
        "transaction_id", "rank", "f.feature", "f.value", "f.contribution"
    )


@query
def explanations(spark, folder):
    """The text of every model column of every row."""
    from riskloom.functions.explain import contributions

    rows = pr.scoring_input(_features(spark, folder))
    every = contributions(IMPORTANCES, top_k=None)
    return rows.select("transaction_id", F.explode_outer(every).alias("f")).select(
        "transaction_id", "f.feature", "f.description"
    )


@query
def risk_factors(spark, folder):
    rows = _explained(spark, folder)
    listed = rows.select("transaction_id", F.posexplode_outer("risk_factors").alias("position", "factor"))
    return listed.where(F.col("factor").isNotNull())


@query
def alerts(spark, folder):
    rows = _explained(spark, folder)
    named = al.new_alerts(rows, "stand-in", "1", created_at=F.col("event_time")).withColumn(
        "first_feature", F.get_json_object("top_features", "$[0].feature")
    )
    return named.select(
        "transaction_id", "user_id", "channel", "decision", "model_name", "model_version",
        "inference_latency_ms", "first_feature",
        F.col("amount").cast("double").alias("amount"),
        F.col("score").cast("double").alias("score"),
        F.col("threshold").cast("double").alias("threshold"),
    )


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


@query
def recent_alerts(spark, folder):
    return _at(_plain(al.recent_alerts(_alert_table(spark, folder))), "created_at")


@query
def alert_stats(spark, folder):
    table = _alert_table(spark, folder)
    now = table.agg(F.max("created_at")).scalar()
    stats = _plain(al.alert_stats(table, now))
    return stats.withColumns({c: cx.half_up(F.col(c), 6) for c in ("avg_score", "avg_latency_ms")})


@query
def alert_counts(spark, folder):
    table = _alert_table(spark, folder)
    return mn.alert_counts(table, table.agg(F.max("created_at")).scalar())


@query
def alert_outcomes(spark, folder):
    outcomes = _txn(spark, folder).select(F.col("transaction_id").cast("string").alias("transaction_id"), "label")
    return al.alert_outcomes(_alert_table(spark, folder), outcomes)


@query
def orphan_features(spark, folder):
    """Feature rows of every event against raw rows that lost every thirteenth."""
    txn = _txn(spark, folder)
    raw = txn.where(F.col("transaction_id") % 13 != 0).select("transaction_id")
    features = txn.select("transaction_id", "user_id")
    return qu.orphans(features, raw).withColumn("state", F.lit("orphan")).unionByName(
        qu.with_raw_event(features, raw).withColumn("state", F.lit("valid"))
    )


# --- drift -----------------------------------------------------------------------------------


@query
def drift_reference(spark, folder):
    return pr.drift_scan(_features(spark, folder), "reference").drop("event_time")


@query
def drift_current(spark, folder):
    return pr.drift_scan(_features(spark, folder), "current").drop("event_time")


# the moment that parts the drift queries' reference period from the current one
DRIFT_MOMENT = "2024-01-21 00:00:00"


def _halves(spark, folder) -> tuple[DataFrame, DataFrame]:
    """All rows before and from a moment, of one stored feature table; it is computed once."""
    features, moment = _stored(spark, folder), F.lit(DRIFT_MOMENT).cast("timestamp")
    return pr.drift_period(features, before=moment), pr.drift_period(features, since=moment)


def _ends(spark, folder, reference: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The first and the last rows, by number."""
    features = _stored(spark, folder)
    return pr.drift_scan(features, "reference", reference), pr.drift_scan(features, "current")


def _stored(spark, folder) -> DataFrame:
    return stored(pr.drift_columns(_features(spark, folder)))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: cx.half_up(F.col(n), digits) for n in names})


def _tested(column: str) -> Query:
    def run(spark, folder):
        tests = dr.feature_tests(*_halves(spark, folder))
        columns = {"drift_wasserstein": ["wasserstein"], "drift_ks": ["ks_d", "ks_p"], "drift_js": ["js_distance"]}
        columns |= {"drift_chi2": ["chi2", "chi2_p"], "drift_ztest": ["z", "z_p"]}
        names = columns[column]
        finite = {n: F.when(F.col(n) < float("inf"), F.col(n)) for n in names}
        return _rounded(tests.withColumns(finite), 6, *names).select("feature", "distinct_values", *names)

    return run


for _name in ("drift_wasserstein", "drift_ks", "drift_js", "drift_chi2", "drift_ztest"):
    _registry[_name] = _tested(_name)


@query
def psi(spark, folder):
    return _rounded(dr.psi(*_halves(spark, folder)), 6, "psi")


@query
def drift_simple(spark, folder):
    simple = dr.simple_drift(*_halves(spark, folder))
    names = [n for n, t in simple.dtypes if t == "double"]
    return _rounded(simple, 6, *names)


@query
def drift_report(spark, folder):
    return dr.drift_report(*_halves(spark, folder))


@query
def drift_report_small(spark, folder):
    """A reference of 1,000 rows or fewer, so p-value tests are chosen."""
    return dr.drift_report(*_ends(spark, folder, 1_000))


@query
def drift_report_n(spark, folder):
    """The first rows against the last, as many as the scheduled check takes."""
    return dr.drift_report(*_ends(spark, folder))


@query
def drift_dataset(spark, folder):
    return dr.drift_dataset(dr.drift_report(*_halves(spark, folder)))


def _by_window(spark, folder):
    features = _stored(spark, folder)
    reference = stored(pr.drift_period(features, before=F.lit(DRIFT_MOMENT).cast("timestamp")))
    return dr.drift_by_window(reference, features, features=DRIFT_FEATURES)


@query
def drift_by_window(spark, folder):
    return _at(_rounded(_by_window(spark, folder), 6, "psi", "reference_mean", "current_mean"))


@query
def drift_trend(spark, folder):
    return _at(_rounded(dr.drift_trend(_by_window(spark, folder)), 6, "worst_score"))


def _summaries(spark, folder) -> tuple[DataFrame, Column]:
    """One stored summary per day and feature, binned on the reference's edges, and which days
    the reference covers."""
    features = _stored(spark, folder)
    before = pr.drift_period(features, before=F.lit(DRIFT_MOMENT).cast("timestamp"))
    edges = sm.read_edges(sm.edges_table(before, DRIFT_FEATURES))
    return stored(sm.summarise(features, edges)), F.col("day") < F.lit(DRIFT_MOMENT).cast("date")


@query
def drift_from_summaries(spark, folder):
    summaries, reference = _summaries(spark, folder)
    simple = sm.drift_between(summaries, reference, ~reference).drop("reference_rows", "current_rows")
    return _rounded(simple, 6, *[n for n, t in simple.dtypes if t == "double"])


@query
def drift_by_day(spark, folder):
    daily = sm.drift_by_day(*_summaries(spark, folder)).withColumnRenamed("day", "window_start")
    return _at(_rounded(daily, 6, "psi", "reference_mean", "current_mean"))


@query
def drift_history(spark, folder):
    """Every day as a run, each compared with the last before it."""
    runs = stored(sm.drift_by_day(*_summaries(spark, folder)))
    found = _rounded(sm.drift_history(runs, run="day"), 6, "psi", "previous_score", "score_change")
    days = ("day", "previous_run", "drifting_since", "first_drift")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in days})


# --- monitoring ----------------------------------------------------------------------------------


@query
def throughput(spark, folder):
    return _at(mn.per_window(_txn(spark, folder), "1 minute", ["channel", "country"]))


@query
def increase_1h(spark, folder):
    return _at(mn.increase(_txn(spark, folder)))


@query
def user_sessions(spark, folder):
    found = mn.sessions(_txn(spark, folder), "6 hours")
    return _at(_at(found), "window_end")


@query
def consumer_lag(spark, folder):
    """Messages of the last day are not committed yet."""
    sent = ms.messages_from(_txn(spark, folder))
    newest = sent.agg(F.max("timestamp")).scalar()
    return mn.consumer_lag(sent, sent.where(F.col("timestamp") < newest - F.expr("interval 1 day")))


@query
def decision_counts(spark, folder):
    return _at(mn.decision_counts(al.decide(_txn(spark, folder)))).withColumn(
        "decisions_per_minute", cx.half_up(F.col("decisions_per_minute"), 6)
    )


@query
def block_rate(spark, folder):
    return _at(mn.block_rate(al.decide(_txn(spark, folder))))


@query
def latency_quantiles(spark, folder):
    rows = _txn(spark, folder).withColumn("seconds", F.col("latency_ms") / 1000)
    found = mn.histogram_quantiles(rows, "seconds", SCORING_BUCKETS, width="1 hour")
    return _at(found).withColumn("seconds", cx.half_up(F.col("seconds"), 9))


@query
def latency_percentiles(spark, folder):
    """Exact quantiles of the same latencies, per channel."""
    from riskloom.operators.ordering import exact_quantiles

    rows = _txn(spark, folder).select("channel", "latency_ms")
    found = exact_quantiles(rows, [0.5, 0.95, 0.99], ["channel"], "latency_ms")
    return found.withColumn("quantile", cx.half_up(F.col("quantile"), 6))


# --- models --------------------------------------------------------------------------------------


@query
def train_classifier(spark, folder):
    """Train, score all splits and report every metric."""
    rows = pr.prepared_features(_split_features(spark, folder))
    scored = mo.score(mo.train_classifier(rows), rows).withColumn("label", F.col("label") == 1)
    return ev.evaluation_report(scored.select("transaction_id", "split", "label", "score"))


@query
def classifier_stages(spark, folder):
    """PR-AUC on the val split after each tree, and the number of trees that is kept."""
    return mo.train_classifier_by_area(stored(pr.prepared_features(_split_features(spark, folder))))[1]


def _trained(spark: SparkSession, folder: str) -> tuple:
    """The documented model, and the feature rows, which are computed once for both."""
    features = stored(_features(spark, folder))
    return mo.train_classifier(pr.prepared_features(_with_split(features))), features


@query
def feature_importance(spark, folder):
    return mo.feature_importance(_trained(spark, folder)[0])


@query
def score_batch(spark, folder):
    model, features = _trained(spark, folder)
    return mo.score(model, pr.scoring_input(features)).select("transaction_id", "score")


@query
def score_pipeline(spark, folder):
    model, features = _trained(spark, folder)
    done = mo.score_and_explain(model, pr.scoring_input(features))
    return done.select("transaction_id", "score", "decision", F.to_json("top_features").alias("top_features"), "risk_factors")


@query
def anomaly_scores(spark, folder):
    """All rows: the score needs no label."""
    features = stored(_features(spark, folder).drop("score", "latency_ms", "merchant_id", "device_id"))
    rows = pr.prepared_features(pr.time_split(features))
    forest = mo.train_isolation_forest(rows.where("split = 'train'"))
    scored = stored(mo.anomaly_scores(forest, rows))
    return ev.normalised(scored, "anomaly_score", "anomaly_norm").select("transaction_id", "label", "anomaly_score", "anomaly_norm")
