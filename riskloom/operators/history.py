"""Per-user history features: every row is described by the user's earlier rows.

Two orders are supported.

``order="time"`` (default) treats event time, then arrival, as the order of a user's
transactions. Look-back windows are swept: each row enters the running totals at its
time and leaves them once per window, so a row costs the same whether the window holds
three rows or five hundred.

``order="arrival"`` follows arrival order exactly, also when events arrive out of
time order: a row sees the last 500 arrivals, filtered by time. Each row carries its
bounded history array, so use it for micro-batches and unordered sources.

Users with very long histories are cut into blocks of consecutive rows. A block also
gets the last 500 rows before it, which is all that any look-back feature may see, so
results do not change; first visits and home country, which look back without limit,
are derived for such users from per-part totals before the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import (
    DAY_US,
    HISTORY_CAP,
    HOUR_US,
    MIN_STATS_ROWS,
    MINUTES_CAP,
    STATS_DAYS,
)
from riskloom.functions.columns import calendar_columns, cents, channel_code, half_up, micros
from riskloom.operators.ordering import before_part, join_same, place_in_order, rank_blocks, time_blocks
from riskloom.session import broadcast_if_small, stored

LONG_USER_ROWS = 200_000
BLOCK_ROWS = 50_000

FEATURE_COLUMNS = [
    "amount_zscore",
    "user_txn_count_1h",
    "user_txn_count_24h",
    "user_txn_count_7d",
    "user_amount_sum_1h",
    "user_amount_sum_24h",
    "user_avg_amount_30d",
    "user_std_amount_30d",
    "country_change_flag",
    "device_change_flag",
    "unique_countries_24h",
    "unique_merchants_24h",
    "unique_devices_24h",
    "user_merchant_first_time",
    "minutes_since_last_txn",
    "is_foreign_txn",
]


# --- cutting long histories --------------------------------------------------


def in_blocks(
    txn: DataFrame,
    order: Sequence[str],
    *,
    overlap: int = HISTORY_CAP,
    reach: int | None = None,
    long_user_rows: int | None = LONG_USER_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, bool]:
    """Add ``_block`` and ``_own``; rows of users above ``long_user_rows`` are spread over
    blocks of ``block_rows`` consecutive rows plus ``overlap`` earlier rows (``_own`` false),
    or, with ``reach``, all rows from that many microseconds before the block's first.

    ``_long`` marks those users' rows; their ``_first_visit`` and ``_home`` are set here.
    ``long_user_rows=None`` skips the counting pass when the caller knows the sizes.
    Also returns whether there are such users.
    """
    whole = dict(
        _block=F.lit(0).cast("bigint"),
        _own=F.lit(True),
        _long=F.lit(False),
        _first_visit=F.lit(None).cast("boolean"),
        _home=F.lit(None).cast(txn.schema["country"].dataType),
    )
    if long_user_rows is None:
        return txn.withColumns(whole), False
    rows = txn.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))
    long_users = stored(rows.where(F.col("_rows") > long_user_rows).select("user_id"))
    if long_users.isEmpty():
        return txn.withColumns(whole), False
    long_users = broadcast_if_small(long_users)
    named = long_users.withColumnRenamed("user_id", "_long_user")
    is_long = F.col("user_id").eqNullSafe(F.col("_long_user"))  # rows without a user may be many
    short = txn.join(named, is_long, "left_anti").withColumns(whole)
    described = _describe_long(txn.join(named, is_long, "left_semi"), order)
    if reach is None:
        cut = rank_blocks(described, block_rows, overlap)
    else:
        cut = time_blocks(described, "user_id", "_us", block_rows, reach)
    cut = cut.withColumn("_long", F.lit(True))
    return short.unionByName(cut.select(*short.columns)), True


def _describe_long(txn: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rank, first visit and home country over a user's whole history, any length.

    Works on balanced parts of the (user, order) sort; what lies in earlier parts comes
    from per-part totals, so no task ever holds a whole user."""
    placed = place_in_order(txn, ["user_id", *order])
    here = Window.partitionBy("user_id", "_part").orderBy("_place")
    country_here = Window.partitionBy("user_id", "_part", "country").orderBy("_place")
    merchant_here = Window.partitionBy("user_id", "_part", "merchant_id").orderBy("_place")
    rows_before = before_part(placed, ["user_id"], {"rows": F.lit(1)})
    of_country = before_part(placed, ["user_id", "country"], {"seen": F.lit(1)})
    of_merchant = before_part(placed, ["user_id", "merchant_id"], {"visits": F.lit(1)})
    by_user = join_same(placed, rows_before, ["user_id", "_part"])
    by_country = join_same(by_user, of_country, ["user_id", "country", "_part"])
    counted = (
        join_same(by_country, of_merchant, ["user_id", "merchant_id", "_part"])
        .withColumn("_rank", F.col("_before_rows") + F.row_number().over(here) - 1)
        .withColumn("_nth", F.col("_before_seen") + F.row_number().over(country_here))
        .withColumn(
            "_first_visit",
            (F.col("_before_visits") == 0) & (F.row_number().over(merchant_here) == 1),
        )
    )
    leader = F.struct(F.col("_nth"), (-F.col("_rank")).alias("_ago"), F.col("country"))
    counted = counted.withColumn("_lead", leader)
    lead_before = before_part(counted, ["user_id"], maxima={"lead": F.col("_lead")})
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    home = F.greatest(F.col("_before_lead"), F.max("_lead").over(earlier))
    return join_same(counted, lead_before, ["user_id", "_part"]).withColumn("_home", home["country"])


# --- parts shared by both orders ---------------------------------------------


def _stats(n: Column, total: Column, squares: Column, amount_cents: Column, min_rows: int) -> dict[str, Column]:
    """Mean, population deviation and z-score from integer sums (exact until the last step)."""
    big = "decimal(38,0)"
    spread = n.cast(big) * squares - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")
    enough = n >= min_rows
    root = F.sqrt(spread.cast("double"))
    return {
        "user_avg_amount_30d": F.when(
            enough & (total != 0),
            F.call_function("div", 2 * total + n, 2 * n).cast("double") / 100,
        ),
        "user_std_amount_30d": F.when(
            enough & (spread > 0), F.floor(root / n + 0.5).cast("double") / 100
        ),
        "amount_zscore": F.when(
            enough & (spread > 0), half_up((n * amount_cents - total) / root, 4)
        ),
    }


def _since_last() -> dict[str, Column]:
    """What compares a row with the one before it."""
    return {
        "country_change_flag": F.coalesce(F.col("_last.country") != F.col("country"), F.lit(False)),
        "device_change_flag": F.coalesce(
            F.col("_last.device_id") != F.col("device_id"), F.lit(False)
        ),
        # least() passes over NULL, but a user's first row has no last one to measure from
        "minutes_since_last_txn": F.when(
            F.col("_last").isNotNull(),
            F.least(((F.col("_us") - F.col("_last._us")) / 60_000_000).cast("bigint"), F.lit(MINUTES_CAP)),
        ),
    }


def _with_visits(df: DataFrame) -> DataFrame:
    """First visit per merchant; expects ``_nth_visit``."""
    first = F.when(F.col("_long"), F.col("_first_visit")).otherwise(F.col("_nth_visit") == 1)
    return df.withColumn("user_merchant_first_time", first)


def _with_home(df: DataFrame, home_country: str | None) -> DataFrame:
    """If wanted, the most frequent earlier country (the country that reached the leading
    count first); expects ``_nth``."""
    if not home_country:
        return df.withColumn("is_foreign_txn", F.lit(None).cast("boolean"))
    earlier = (
        Window.partitionBy("user_id", "_block")
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lead = F.max(F.struct("_nth", (-F.col("_row")).alias("_ago"), "country")).over(earlier)
    home = F.when(F.col("_long"), F.col("_home")).otherwise(lead["country"])
    return df.withColumn("_home", home).withColumn("is_foreign_txn", F.col("country") != F.col("_home"))


def _with_visits_and_home(df: DataFrame, home_country: str | None) -> DataFrame:
    return _with_home(_with_visits(df), home_country)


_DONE = [
    "country_change_flag",
    "device_change_flag",
    "minutes_since_last_txn",
    "user_merchant_first_time",
    "is_foreign_txn",
]


def _prepared(txn: DataFrame, arrival: str) -> DataFrame:
    return txn.withColumns(
        {"_us": micros(F.col("event_time")), "_cents": cents(F.col("amount")), "_arrival": F.col(arrival)}
    )


def _packed(txn: DataFrame, arrival: str) -> DataFrame:
    """The columns the windows work on, with the whole row as one struct beside them:
    sorts and windows then move one value instead of every column."""
    return _prepared(txn, arrival).select(
        "user_id", "country", "merchant_id", "device_id", "_us", "_cents", "_arrival",
        F.struct(*txn.columns).alias("_txn"),
    )


# --- time order: sweep --------------------------------------------------------

_WINDOWS = {"1h": HOUR_US, "24h": DAY_US, "7d": 7 * DAY_US}


# the features that need a look-back window, in the order of the sweep's kinds
_SWEPT = [
    {"user_txn_count_1h", "user_amount_sum_1h"},
    {
        "user_txn_count_24h", "user_amount_sum_24h",
        "unique_countries_24h", "unique_merchants_24h", "unique_devices_24h",
    },
    {"user_txn_count_7d"},
    {"user_avg_amount_30d", "user_std_amount_30d", "amount_zscore"},
]
_UNIQUE = {
    "country": ("c", "unique_countries_24h"),
    "merchant_id": ("m", "unique_merchants_24h"),
    "device_id": ("d", "unique_devices_24h"),
}


def _time_order(
    txn: DataFrame, cap: int | None, stats_days: int, min_rows: int, home: str | None, cut: dict, wanted: set[str]
) -> DataFrame:
    keep = txn.columns
    done = [c for c in _DONE if c in wanted]
    kinds = [k for k, names in enumerate(_SWEPT, start=1) if names & wanted]
    spans = [*_WINDOWS.values(), stats_days * DAY_US]
    reach = max((spans[k - 1] for k in kinds), default=0) if cap is None else None
    rows, _ = in_blocks(_packed(txn, cut.pop("arrival")), ["_us", "_arrival"], overlap=cap or 1, reach=reach, **cut)
    user = Window.partitionBy("user_id", "_block").orderBy("_us", "_arrival")
    compared = {n: c for n, c in _since_last().items() if n in wanted}
    places = {"_row": F.row_number().over(user)}
    if kinds and cap is not None:
        places["_cap_us"] = F.lead("_us", cap + 1).over(user)
    if compared:
        places["_last"] = F.lag(F.struct("_us", "country", "device_id")).over(user)
    rows = rows.withColumns(places).withColumns(compared).drop("_last")
    # for each 24-hour distinct count: does this row bring its value into the window,
    # and does the value go when the row goes
    for value, (short, name) in _UNIQUE.items():
        same = Window.partitionBy("user_id", "_block", value).orderBy("_row")
        if name in wanted:
            here = F.struct("_us", "_row")
            rows = rows.withColumns({"_prev": F.lag(here).over(same), "_next": F.lead(here).over(same)})
            near = lambda old, new: (
                (new["_us"] - old["_us"] <= DAY_US) & (F.lit(cap is None) | (new["_row"] - old["_row"] <= (cap or 0)))
            )
            this = {"_row": F.col("_row"), "_us": F.col("_us")}
            alone_in = ~F.coalesce(near(F.col("_prev"), this), F.lit(False))
            alone_out = ~F.coalesce(near(this, F.col("_next")), F.lit(False))
            known = F.col(value).isNotNull()
            rows = rows.withColumns(
                {
                    f"_{short}_in": (known & alone_in).cast("int"),
                    f"_{short}_out": (known & alone_out).cast("int"),
                }
            ).drop("_prev", "_next")
        if value == "country" and home and "is_foreign_txn" in wanted:
            rows = rows.withColumn("_nth", F.row_number().over(same))
        if value == "merchant_id" and "user_merchant_first_time" in wanted:
            rows = rows.withColumn("_nth_visit", F.row_number().over(same))
    if "user_merchant_first_time" in wanted:
        rows = _with_visits(rows)
    if "is_foreign_txn" in wanted:
        rows = _with_home(rows, home)
    own = [F.col(f"_txn.{c}").alias(c) for c in keep]
    if not kinds:  # nothing looks back further than one row or value
        return rows.where("_own").select(*own, *done)

    payload = F.struct("_txn", "_cents", "_own", *done)
    none = F.lit(None).cast("int")
    nothing = F.lit(None).cast(rows.select(payload.alias("p")).schema["p"].dataType)

    def step(kind: int, at: Column, late: Column, row: Column, side: int, **other: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("_kind"),
            at.alias("_at"),
            late.alias("_late"),
            row.alias("_pos"),
            F.lit(side).alias("_side"),
            F.col("_cents").alias("_amount"),
            other.get("c", none).alias("_c"),
            other.get("m", none).alias("_m"),
            other.get("d", none).alias("_d"),
            (payload if kind == 0 else nothing).alias("_row_out"),
        )

    shorts = [short for short, name in _UNIQUE.values() if name in wanted]
    steps = [
        step(0, F.col("_us"), F.lit(0), F.col("_row"), 1, **{x: F.col(f"_{x}_in") for x in shorts})
    ]
    for kind in kinds:
        span = spans[kind - 1]
        # a row leaves after the last moment it is inside the window, or just before
        # the row that pushes it out of the newest `cap`
        pushed = F.lit(False) if cap is None else F.coalesce(F.col("_cap_us") <= F.col("_us") + span, F.lit(False))
        gone = {x: -F.col(f"_{x}_out") for x in shorts} if kind == 2 else {}
        steps.append(
            step(
                kind,
                F.when(pushed, F.col("_cap_us") if cap is not None else F.lit(None)).otherwise(F.col("_us") + span),
                F.when(pushed, 0).otherwise(1),
                F.when(pushed, F.col("_row") + (cap or 0) + 1).otherwise(F.col("_row")),
                0,
                **gone,
            )
        )
    swept = rows.select("user_id", "_block", F.inline(F.array(*steps)))
    before = (
        Window.partitionBy("user_id", "_block")
        .orderBy("_at", "_late", "_pos", "_side")
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def live(kind: int, value: Column) -> Column:
        change = F.when(F.col("_kind") == 0, value).when(F.col("_kind") == kind, -value)
        return F.coalesce(F.sum(change).over(before), F.lit(0))

    amount = F.col("_amount")
    square = amount.cast("decimal(13,0)") * amount.cast("decimal(13,0)")
    measured = swept.select(
        "_kind",
        "_row_out",
        live(1, F.lit(1)).alias("_n1"),
        live(2, F.lit(1)).alias("_n24"),
        live(3, F.lit(1)).alias("_n7"),
        live(4, F.lit(1)).alias("_n30"),
        live(1, amount).alias("_s1"),
        live(2, amount).alias("_s24"),
        live(4, amount).alias("_s30"),
        live(4, square).alias("_q30"),
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in ("_c", "_m", "_d")],
    )
    measured = measured.where((F.col("_kind") == 0) & F.col("_row_out._own"))
    flat = measured.select("_row_out.*", *[c for c in measured.columns if c != "_row_out"])
    features = {
        "user_txn_count_1h": F.col("_n1").cast("int"),
        "user_txn_count_24h": F.col("_n24").cast("int"),
        "user_txn_count_7d": F.col("_n7").cast("int"),
        "user_amount_sum_1h": F.col("_s1").cast("double") / 100,
        "user_amount_sum_24h": F.col("_s24").cast("double") / 100,
        **_stats(F.col("_n30"), F.col("_s30"), F.col("_q30"), F.col("_cents"), min_rows),
        "unique_countries_24h": F.col("_c").cast("int"),
        "unique_merchants_24h": F.col("_m").cast("int"),
        "unique_devices_24h": F.col("_d").cast("int"),
    }
    return flat.select(*own, *[c.alias(n) for n, c in features.items() if n in wanted], *done)


# --- arrival order: bounded history arrays ------------------------------------


def _arrival_order(txn: DataFrame, cap: int, stats_days: int, min_rows: int, home: str | None, cut: dict) -> DataFrame:
    keep = txn.columns
    rows, _ = in_blocks(_packed(txn, cut.pop("arrival")), ["_arrival"], overlap=cap, **cut)
    user = Window.partitionBy("user_id", "_block").orderBy("_arrival")
    rows = rows.withColumns(
        {
            "_row": F.row_number().over(user),
            "_last": F.lag(F.struct("_us", "country", "device_id")).over(user),
            "_past": F.collect_list(
                F.struct("_us", "_cents", "country", "merchant_id", "device_id")
            ).over(user.rowsBetween(-cap, -1)),
            "_nth_visit": F.row_number().over(
                Window.partitionBy("user_id", "_block", "merchant_id").orderBy("_arrival")
            ),
        }
    )
    if home:
        rows = rows.withColumn(
            "_nth",
            F.row_number().over(
                Window.partitionBy("user_id", "_block", "country").orderBy("_arrival")
            ),
        )
    rows = _with_visits_and_home(rows.withColumns(_since_last()), home).where("_own")

    def since(span: int) -> Column:
        return F.filter("_past", lambda p: p["_us"] >= F.col("_us") - span)

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, p: acc + p["_cents"])

    def distinct(items: Column, name: str) -> Column:
        return F.size(F.array_distinct(F.filter(F.transform(items, lambda p: p[name]), lambda v: v.isNotNull())))

    rows = rows.withColumns(
        {
            "_in1": since(HOUR_US),
            "_in24": since(DAY_US),
            "_in7": since(7 * DAY_US),
            "_in30": since(stats_days * DAY_US),
        }
    )
    squares = F.aggregate(
        "_in30",
        F.lit(0).cast("decimal(38,0)"),
        lambda acc, p: (
            acc + p["_cents"].cast("decimal(13,0)") * p["_cents"].cast("decimal(13,0)")
        ).cast("decimal(38,0)"),
    )
    rows = rows.withColumns({"_n30": F.size("_in30").cast("bigint"), "_s30": total(F.col("_in30")), "_q30": squares})
    return rows.select(
        *[F.col(f"_txn.{c}").alias(c) for c in keep],
        F.size("_in1").alias("user_txn_count_1h"),
        F.size("_in24").alias("user_txn_count_24h"),
        F.size("_in7").alias("user_txn_count_7d"),
        (total(F.col("_in1")).cast("double") / 100).alias("user_amount_sum_1h"),
        (total(F.col("_in24")).cast("double") / 100).alias("user_amount_sum_24h"),
        *[
            c.alias(n)
            for n, c in _stats(
                F.col("_n30"), F.col("_s30"), F.col("_q30"), F.col("_cents"), min_rows
            ).items()
        ],
        distinct(F.col("_in24"), "country").alias("unique_countries_24h"),
        distinct(F.col("_in24"), "merchant_id").alias("unique_merchants_24h"),
        distinct(F.col("_in24"), "device_id").alias("unique_devices_24h"),
        *_DONE,
    )


# --- public operators ----------------------------------------------------------


def history_features(
    txn: DataFrame,
    *,
    order: str = "time",
    arrival: str = "transaction_id",
    cap: int | None = HISTORY_CAP,
    stats_days: int = STATS_DAYS,
    min_rows: int = MIN_STATS_ROWS,
    home_country: str | None = "mode_of_history",
    long_user_rows: int | None = LONG_USER_ROWS,
    block_rows: int = BLOCK_ROWS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All look-back features of every transaction, or those named in ``columns``, next to
    its own columns. The plan sorts and sweeps for the named ones only.

    ``arrival`` is the column that orders a user's rows as they came in (unique per
    user). A look-back sees at most the newest ``cap`` rows; None, for the time order, lifts
    that bound. ``stats_days=7`` gives the form whose amount history is trimmed to a week;
    ``home_country=None`` leaves ``is_foreign_txn`` empty.
    """
    cut = dict(arrival=arrival, long_user_rows=long_user_rows, block_rows=block_rows)
    wanted = set(FEATURE_COLUMNS if columns is None else columns)
    if not wanted <= set(FEATURE_COLUMNS):
        raise ValueError(f"unknown features {sorted(wanted - set(FEATURE_COLUMNS))}")
    if order == "time":
        return _time_order(txn, cap, stats_days, min_rows, home_country, cut, wanted)
    if order == "arrival":
        if cap is None:
            raise ValueError("order='arrival' needs a cap")
        every = _arrival_order(txn, cap, stats_days, min_rows, home_country, cut)
        return every.drop(*[c for c in FEATURE_COLUMNS if c not in wanted])
    raise ValueError(f"unknown order {order!r}")


def feature_rows(txn: DataFrame, **options) -> DataFrame:
    """The complete feature row: history, calendar and channel columns."""
    return history_features(txn, **options).withColumns(
        {
            **calendar_columns(F.col("event_time")),
            "channel_encoded": channel_code(F.col("channel")),
        }
    )


def home_countries(
    txn: DataFrame, *, arrival: str = "transaction_id", long_user_rows: int | None = LONG_USER_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``home_country``, the most frequent country of the user's earlier rows (the
    one that reached the leading count first), and ``is_foreign_txn``."""
    order = ["_us", "_arrival"]
    rows, _ = in_blocks(_prepared(txn, arrival), order, long_user_rows=long_user_rows, block_rows=block_rows)
    country = Window.partitionBy("user_id", "_block", "country").orderBy(*order)
    rows = rows.withColumns(
        {
            "_row": F.row_number().over(Window.partitionBy("user_id", "_block").orderBy(*order)),
            "_nth": F.row_number().over(country),
            "_nth_visit": F.lit(1),
        }
    )
    return _with_visits_and_home(rows, "mode_of_history").where("_own").select(
        *txn.columns,
        F.col("_home").alias("home_country"),
        (F.col("country") != F.col("_home")).alias("is_foreign_txn"),
    )


def with_history_number(
    txn: DataFrame,
    *,
    idle_days: int = 7,
    arrival: str = "transaction_id",
    long_user_rows: int | None = LONG_USER_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``history_number``, which grows whenever a user was idle for longer than
    ``idle_days`` and is then forgotten. Follows event time, not a wall clock.

    The blocks of a long user are numbered on their own; the histories begun in earlier
    blocks, one row per block, are then added."""
    order = ["_us", "_arrival"]
    rows, has_long = in_blocks(
        _prepared(txn, arrival), order, overlap=1, long_user_rows=long_user_rows, block_rows=block_rows
    )
    user = Window.partitionBy("user_id", "_block").orderBy(*order)
    gap = F.col("_us") - F.lag("_us").over(user)
    rows = rows.withColumn("_starts", F.coalesce(gap > idle_days * DAY_US, F.lit(True)).cast("int"))
    rows = rows.where("_own").withColumn("history_number", F.sum("_starts").over(user))
    if has_long:
        rows = stored(rows.select(*txn.columns, "_block", "_starts", "history_number"))
        blocks = rows.groupBy("user_id", "_block").agg(F.sum("_starts").alias("_n"))
        earlier = Window.partitionBy("user_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.select("user_id", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begun"))
        rows = join_same(rows, blocks, ["user_id", "_block"]).withColumn(
            "history_number", F.col("history_number") + F.col("_begun")
        )
    return rows.select(*txn.columns, "history_number")


def idle_reset(txn: DataFrame, *, arrival: str = "transaction_id", **options) -> DataFrame:
    """Add ``history_number`` and ``first_since_reset``, whether the merchant is new within
    that history."""
    rows = with_history_number(txn, arrival=arrival, **options)
    firsts = rows.groupBy("user_id", "history_number", "merchant_id").agg(
        F.min(F.struct("event_time", arrival)).alias("_first")
    )
    first = F.struct("event_time", arrival) == F.col("_first")
    keys = ["user_id", "history_number", "merchant_id"]
    return join_same(stored(rows), firsts, keys).select(
        *txn.columns, "history_number", first.alias("first_since_reset")
    )


def features_with_expiry(
    txn: DataFrame,
    *,
    idle_days: int = 7,
    arrival: str = "transaction_id",
    long_user_rows: int | None = LONG_USER_ROWS,
    block_rows: int = BLOCK_ROWS,
    **options,
) -> DataFrame:
    """The feature row of users who are forgotten after ``idle_days`` without a row, and
    ``history_number``: every look-back, the last row, first visits and the home country
    see only the rows since the user came back.

    A history between two pauses is what the windows run over, in place of the user: the
    sweep's running totals, visits and leading countries start anew with it. Histories that
    are still long are cut into blocks as users are."""
    cut = dict(long_user_rows=long_user_rows, block_rows=block_rows)
    numbered = with_history_number(txn, idle_days=idle_days, arrival=arrival, **cut)
    key = F.struct("user_id", "history_number")
    as_user = numbered.select(*[c for c in txn.columns if c != "user_id"], key.alias("user_id"))
    found = feature_rows(as_user, arrival=arrival, **cut, **options)
    rest = [c for c in found.columns if c != "user_id"]
    return found.select("user_id.*", *rest)


def active_users(txn: DataFrame, *, days: int = 7, max_users: int = 100_000, evict: int = 1_000) -> DataFrame:
    """One row per user: newest event, rows, whether the user was active in the last
    ``days`` of the table, and whether it is among the ``evict`` longest idle users that
    go when there are at least ``max_users``."""
    users = txn.groupBy("user_id").agg(
        F.max(micros(F.col("event_time"))).alias("last_us"), F.count(F.lit(1)).alias("transactions")
    )
    newest = users.agg(F.max("last_us")).scalar()
    size = users.agg(F.count(F.lit(1))).scalar()
    oldest = (
        users.orderBy("last_us", "user_id").limit(evict).select("user_id", F.lit(True).alias("_oldest"))
    )
    # at most `evict` ids
    return users.join(F.broadcast(oldest), "user_id", "left").select(
        "user_id",
        "last_us",
        "transactions",
        (F.col("last_us") >= newest - days * DAY_US).alias("tracked"),
        (F.coalesce("_oldest", F.lit(False)) & (size >= max_users)).alias("evicted"),
    )


def since(txn: DataFrame, moment: Column) -> DataFrame:
    """The slice of a history at or after a moment."""
    return txn.where(F.col("event_time") >= moment)
