"""Training and scoring frames: scans, defaults, time-ordered split, medians, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import (
    DRIFT_CURRENT_ROWS,
    DRIFT_MIN_ROWS,
    DRIFT_REFERENCE_ROWS,
    MIN_TRAINING_ROWS,
    MODEL_FEATURES,
    SPLIT,
)
from riskloom.functions.columns import (
    calendar_columns,
    channel_code_for_scoring,
    number_or_zero,
    ratio_or_zero,
)
from riskloom.operators.ordering import key_of, ranked, rows_at
from riskloom.operators.selection import selected_quantiles
from riskloom.session import stored

# fixed values: the columns of a training frame
TRAINING_COLUMNS = [
    "transaction_id", "user_id", "event_time",
    "amount", "amount_zscore", "user_avg_amount_30d", "user_std_amount_30d",
    "user_txn_count_1h", "user_txn_count_24h", "user_txn_count_7d",
    "user_amount_sum_1h", "user_amount_sum_24h",
    "country_change_flag", "device_change_flag",
    "unique_countries_24h", "unique_merchants_24h", "unique_devices_24h",
    "user_merchant_first_time",
    "hour_of_day", "day_of_week", "is_weekend", "is_night", "minutes_since_last_txn",
    "channel", "channel_encoded", "country", "is_foreign_txn", "label",
]


class NotEnoughRows(ValueError):
    pass


def labelled_scan(features: DataFrame, min_rows: int | None = MIN_TRAINING_ROWS) -> DataFrame:
    """Labelled rows with the training columns. Raises when there are fewer than
    ``min_rows``; the check stops reading once it has seen enough."""
    rows = features.where(F.col("label").isNotNull()).select(*TRAINING_COLUMNS)
    if min_rows:
        seen = features.where(F.col("label").isNotNull()).select("label").limit(min_rows).count()
        if seen < min_rows:
            raise NotEnoughRows(f"got {seen} labelled rows, need at least {min_rows}")
    return rows


# --- scoring and drift defaults ------------------------------------------------


def scoring_input(rows: DataFrame, clock: str = "event") -> DataFrame:
    """The model columns of each row, with the defaults used when a value is absent.

    ``clock="event"`` takes calendar features from the event; ``"now"`` from the wall clock."""
    time = F.col("event_time") if clock == "event" else F.current_timestamp()
    names = set(rows.columns)

    def given(name: str, default: Column | float) -> Column:
        default = default if isinstance(default, Column) else F.lit(default)
        value = F.coalesce(F.col(name), default) if name in names else default
        return value.cast("double")

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name).cast("int"), F.lit(0)) if name in names else F.lit(0)

    amount = F.col("amount").cast("double")
    calendar = calendar_columns(time)
    columns = {
        "amount": amount,
        "amount_zscore": given("amount_zscore", 0.0),
        "user_avg_amount_30d": given("user_avg_amount_30d", amount),
        "user_txn_count_1h": given("user_txn_count_1h", 0).cast("int"),
        "user_txn_count_24h": given("user_txn_count_24h", 1).cast("int"),
        "user_txn_count_7d": given("user_txn_count_7d", 1).cast("int"),
        "user_amount_sum_1h": given("user_amount_sum_1h", amount),
        "user_amount_sum_24h": given("user_amount_sum_24h", amount),
        "country_change_flag": flag("country_change_flag"),
        "device_change_flag": flag("device_change_flag"),
        "unique_countries_24h": given("unique_countries_24h", 1).cast("int"),
        "unique_merchants_24h": given("unique_merchants_24h", 1).cast("int"),
        "user_merchant_first_time": flag("user_merchant_first_time"),
        "hour_of_day": calendar["hour_of_day"],
        "day_of_week": calendar["day_of_week"],
        "is_weekend": calendar["is_weekend"].cast("int"),
        "is_night": calendar["is_night"].cast("int"),
        "minutes_since_last_txn": given("minutes_since_last_txn", 60).cast("int"),
        "channel_encoded": channel_code_for_scoring(F.col("channel")),
    }
    carried = [c for c in rows.columns if c not in columns]
    return rows.select(*carried, *[columns[n].alias(n) for n in MODEL_FEATURES])


def score_input(transactions: DataFrame, features: DataFrame) -> DataFrame:
    """Transactions joined with their stored features by id, defaults where there are none."""
    known = features.select(
        "transaction_id", *[c for c in MODEL_FEATURES if c not in ("amount", "channel_encoded")]
    )
    calendar = list(calendar_columns(F.lit(None)))
    return scoring_input(transactions.join(known.drop(*calendar), "transaction_id", "left"))


# fixed values: what the drift scan puts in place of NULL, where it is not zero
_DRIFT_DEFAULTS = {"unique_countries_24h": 1, "unique_merchants_24h": 1, "hour_of_day": 12}
DRIFT_COLUMNS = [*MODEL_FEATURES, "label"]


def drift_columns(features: DataFrame) -> DataFrame:
    """The drift frame: NULLs replaced, flags as 0/1, numbers as doubles."""
    kinds = dict(features.dtypes)

    def column(name: str) -> Column:
        default = F.lit(_DRIFT_DEFAULTS.get(name, 0))
        if kinds[name] == "boolean":
            return F.coalesce(F.col(name).cast("int"), default.cast("int"))
        if kinds[name] == "string":  # text that is no number counts as 0, a missing one as the default
            return F.when(F.col(name).isNull(), default.cast("double")).otherwise(number_or_zero(F.col(name)))
        return F.coalesce(F.col(name).cast("double"), default.cast("double"))

    present = [n for n in DRIFT_COLUMNS if n in kinds]
    return features.select("transaction_id", "event_time", *[column(n).alias(n) for n in present])


def drift_scan(features: DataFrame, which: str, rows: int | None = None, order_by: Sequence[str] = ("event_time", "transaction_id")) -> DataFrame:
    """The first (``reference``) or last (``current``) rows in the given order.

    Only the wanted rows leave each task: Spark plans this as a top-k per partition."""
    if which == "reference":
        order, rows = [F.asc(c) for c in order_by], rows or DRIFT_REFERENCE_ROWS
    elif which == "current":
        order, rows = [F.desc(c) for c in order_by], rows or DRIFT_CURRENT_ROWS
    else:
        raise ValueError(f"unknown scan {which!r}")
    return drift_columns(features).orderBy(*order).limit(rows)


def drift_period(
    features: DataFrame, since: Column | None = None, before: Column | None = None, time: str = "event_time"
) -> DataFrame:
    """All rows of a period, from ``since`` on and ``before`` a moment."""
    frame = drift_columns(features)
    if since is not None:
        frame = frame.where(F.col(time) >= since)
    return frame if before is None else frame.where(F.col(time) < before)


def enough_for_drift(rows: DataFrame, minimum: int = DRIFT_MIN_ROWS) -> bool:
    return rows.limit(minimum).count() >= minimum


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles; text that is not a number becomes 0."""
    return df.withColumns({c: number_or_zero(F.col(c)) for c in columns})


# --- split and medians -----------------------------------------------------------


def time_split(
    df: DataFrame,
    ratios: Sequence[float] = SPLIT,
    time: str = "event_time",
    tie: str = "transaction_id",
) -> DataFrame:
    """Add ``split`` (train / val / test) by position in (time, id) order.

    Only the two keys at the cut positions are looked up; the frame itself is then
    labelled by comparison, without a shuffle."""
    if abs(sum(ratios) - 1.0) >= 0.01:
        raise ValueError("ratios must sum to 1")
    rows = df.count()
    cuts = [int(rows * ratios[0]), int(rows * (ratios[0] + ratios[1]))]
    found = rows_at(df, [time, tie], cuts, rows)

    def from_cut(position: int) -> Column:
        if position not in found:
            return F.lit(False)
        here, cut = key_of(df, found[position], [time, tie])
        return here >= cut

    return df.withColumn(
        "split",
        F.when(from_cut(cuts[1]), "test").when(from_cut(cuts[0]), "val").otherwise("train"),
    )


def prepared_features(
    df: DataFrame,
    columns: Sequence[str] = tuple(MODEL_FEATURES),
    target: str = "label",
    fit_on: str | None = None,
) -> DataFrame:
    """Model columns that exist, flags as 0/1, NULLs as the exact median.

    Each split uses its own median; ``fit_on="train"`` uses that split's for all."""
    kinds = dict(df.dtypes)
    present = [c for c in columns if c in kinds]
    typed = df.select(
        "transaction_id",
        "split",
        F.col(target).cast("int").alias(target),
        *[
            (F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c).cast("double")).alias(c)
            for c in present
        ],
    )
    flags = [c for c in present if kinds[c] == "boolean"]
    medians = selected_quantiles(typed, [c for c in present if c not in flags], "split", only_gaps=True)

    def filled(c: str) -> Column:
        if fit_on:
            return F.coalesce(F.col(c), F.lit(medians.get(fit_on, {}).get(c)), F.lit(0.0))
        own = [F.when(F.col("split").eqNullSafe(s), F.lit(m[c])) for s, m in medians.items()]
        return F.coalesce(F.col(c), *own, F.lit(0.0))

    gaps = dict.fromkeys(c for m in medians.values() for c in m)
    return typed.withColumns({c: filled(c) for c in gaps}).fillna(0, flags)


# --- statistics --------------------------------------------------------------------


def _label_stats() -> list[Column]:
    positive = F.count_if(F.col("label"))
    labelled = F.count("label")
    return [
        F.count(F.lit(1)).alias("total_rows"),
        positive.alias("fraud_count"),
        F.count_if(~F.col("label")).alias("legitimate_count"),
        ratio_or_zero(positive, labelled).alias("fraud_rate"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    ]


def dataset_stats(df: DataFrame) -> DataFrame:
    """Row counts, label counts, time range and the exact number of users.

    One partial aggregate per user feeds the totals, so the distinct count needs no
    second copy of the data."""
    per_user = df.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label")).alias("pos"),
        F.count_if(~F.col("label")).alias("neg"),
        F.min("event_time").alias("lo"),
        F.max("event_time").alias("hi"),
    )
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("fraud_count"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("legitimate_count"),
        ratio_or_zero(F.sum("pos"), F.sum("pos") + F.sum("neg")).alias("fraud_rate"),
        F.min("lo").alias("first_time"),
        F.max("hi").alias("last_time"),
        F.count("user_id").alias("unique_users"),
    )


def split_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(*_label_stats())


def data_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("transaction_id").alias("oldest_transaction"),
        F.max("transaction_id").alias("newest_transaction"),
    )


def class_balance(df: DataFrame) -> DataFrame:
    """Negatives per positive (1 without positives), the weight of a positive row."""
    pos, neg = F.count_if(F.col("label")), F.count_if(~F.col("label"))
    return df.agg(
        neg.alias("negatives"),
        pos.alias("positives"),
        F.when(pos > 0, neg / pos).otherwise(F.lit(1.0)).alias("positive_weight"),
    )


def data_fingerprint(df: DataFrame) -> DataFrame:
    """A fingerprint of ids and labels that does not depend on row order: changes when a
    row is added, dropped, repeated or relabelled. 16 hex digits."""
    row = F.md5(F.concat_ws("|", F.col("transaction_id").cast("string"), F.col("label").cast("string")))
    part = lambda start: F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(part(1)).alias("h"), F.sum(part(16)).alias("g")
    ).select(
        F.col("n").alias("total_rows"),
        F.substring(F.md5(F.concat_ws("|", "n", "h", "g")), 1, 16).alias("fingerprint"),
    )


HASH_FANOUT = 1_024


def order_hash(
    df: DataFrame, order: Sequence[str] = ("event_time", "transaction_id"), columns: Sequence[str] = ("transaction_id", "label"),
    fanout: int = HASH_FANOUT,
) -> DataFrame:
    """``total_rows, data_hash``: a hash of the rows in their order, 16 hex digits. It changes when
    two rows change places, and when one is added, dropped or altered.

    A tree: ``fanout`` consecutive rows make a leaf, ``fanout`` nodes the node above them, up to
    one root. Nodes follow ranks in the whole order, so the hash does not depend on how the
    rows are cut into partitions, and no task sees more than ``fanout`` hashes of a node."""
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    at = ranked(df.select(*order, row.alias("hash")), list(order)).select(F.col("_rank").alias("at"), "hash")
    total, nodes = None, None
    while nodes is None or nodes > 1:
        level = at.groupBy(F.floor(F.col("at") / fanout).alias("at")).agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("parts")
        )
        level = stored(level.select("at", "n", F.sha2(F.array_join("parts.hash", ""), 256).alias("hash")))
        sums = level.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        total = sums[0] if total is None else total
        nodes, at = sums[1], level.select("at", "hash")
    return at.agg(F.max("hash").alias("h")).select(
        F.lit(total).cast("long").alias("total_rows"),
        F.substring(F.coalesce("h", F.sha2(F.lit(""), 256)), 1, 16).alias("data_hash"),
    )
