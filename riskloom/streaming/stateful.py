"""History features with Spark's keyed state instead of a history table.

Each user's state holds what a row may look back at: the newest 500 arrivals as a list, the
merchants seen and the rows per country as maps, of which a micro-batch touches only the keys
in it, and the leading country. All rows of a user in a micro-batch are measured together, by
array operations over the list and the new rows. A pause in event time longer than
``idle_days`` starts a user anew, as in the batch form; ``ttl`` also lets Spark drop the state
of users that send nothing for that long by the clock.

One user's rows of a micro-batch meet in one task, so limit the rows per trigger at the source;
the foreachBatch job cuts long users into blocks instead."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.constants import DAY_US, HISTORY_CAP, HOUR_US, MIN_STATS_ROWS, MINUTES_CAP, STATS_DAYS

ARRIVAL = "us bigint, cents bigint, country string, merchant string, device string"
OUTPUT = (
    "transaction_id string, user_id string, event_us bigint, history_number bigint, user_txn_count_1h int, user_txn_count_24h int, "
    "user_txn_count_7d int, user_amount_sum_1h double, user_amount_sum_24h double, "
    "user_avg_amount_30d double, user_std_amount_30d double, amount_zscore double, "
    "country_change_flag boolean, device_change_flag boolean, unique_countries_24h int, "
    "unique_merchants_24h int, unique_devices_24h int, user_merchant_first_time boolean, "
    "minutes_since_last_txn bigint, is_foreign_txn boolean"
)
INPUT = ["transaction_id", "user_id", "event_us", "cents", "country", "merchant_id", "device_id", "arrival_order"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEASURED = 256  # rows measured at once


def _or_none(values: np.ndarray, given: np.ndarray) -> list:
    return [v if g else None for v, g in zip(values.tolist(), given.tolist(), strict=True)]


def _text(column: pd.Series) -> np.ndarray:
    """Text with None where a value is missing."""
    return column.astype(object).where(column.notna(), None).to_numpy(object)


def look_back(past: dict[str, np.ndarray], new: dict[str, np.ndarray], cap: int) -> dict[str, list]:
    """The windowed features and those against the last row, of ``new`` rows in arrival order
    behind the rows of ``past``. Both hold ``us, cents, country, merchant, device``."""
    both = {n: np.concatenate([past[n], new[n]]) for n in new}
    first, out = len(past["us"]), {}
    for start in range(first, len(both["us"]), MEASURED):
        end = min(start + MEASURED, len(both["us"]))
        low = max(0, start - cap)
        part = _measure({n: v[low:end] for n, v in both.items()}, start - low, cap)
        for name, values in part.items():
            out.setdefault(name, []).extend(values)
    return out


def _measure(rows: dict[str, np.ndarray], first: int, cap: int) -> dict[str, list]:
    """Features of the rows from ``first`` on; all they look back at is in ``rows``."""
    us, cents = rows["us"], rows["cents"]
    own, place = np.arange(first, len(us)), np.arange(len(us))
    before = (place < own[:, None]) & (place >= own[:, None] - cap)
    within = lambda span: before & (us >= us[own][:, None] - span)
    in1, in24, in7, in30 = (within(s) for s in (HOUR_US, DAY_US, 7 * DAY_US, STATS_DAYS * DAY_US))
    exact = cents.astype(object)  # whole numbers of any size
    n = in30.sum(axis=1).astype(object)
    total = np.array([exact[m].sum() for m in in30], object)
    squares = np.array([(exact[m] * exact[m]).sum() for m in in30], object)
    spread = n * squares - total * total
    enough = n >= MIN_STATS_ROWS
    spreads = enough & (spread > 0)
    safe_n, root = np.where(n > 0, n, 1), np.sqrt(np.where(spreads, spread, 1).astype(float))

    def distinct(name: str) -> list[int]:
        codes = pd.factorize(rows[name])[0]
        order = np.argsort(codes, kind="stable")
        order = order[codes[order] >= 0]  # missing values count nowhere
        if not len(order):
            return [0] * len(own)
        starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) > 0])
        return np.logical_or.reduceat(in24[:, order], starts, axis=1).sum(axis=1).tolist()

    has_last = own > 0
    last = np.maximum(own - 1, 0)
    changed = lambda name: has_last & (rows[name][last] != rows[name][own])
    given = np.array([a is not None and b is not None for a, b in zip(rows["device"][last], rows["device"][own], strict=True)], bool)
    known = np.array([a is not None and b is not None for a, b in zip(rows["country"][last], rows["country"][own], strict=True)], bool)
    minutes = np.trunc((us[own] - us[last]) / 60_000_000).astype(np.int64)
    return {
        "user_txn_count_1h": in1.sum(axis=1).tolist(),
        "user_txn_count_24h": in24.sum(axis=1).tolist(),
        "user_txn_count_7d": in7.sum(axis=1).tolist(),
        "user_amount_sum_1h": ((in1 @ cents) / 100).tolist(),
        "user_amount_sum_24h": ((in24 @ cents) / 100).tolist(),
        "user_avg_amount_30d": _or_none((2 * total + n) // (2 * safe_n) / 100, enough & (total != 0)),
        "user_std_amount_30d": _or_none(np.floor(root / safe_n.astype(float) + 0.5) / 100, spreads),
        "amount_zscore": _or_none(np.floor((n * exact[own] - total).astype(float) / root * 10000 + 0.5) / 10000, spreads),
        "country_change_flag": (changed("country") & known).tolist(),
        "device_change_flag": (changed("device") & given).tolist(),
        "unique_countries_24h": distinct("country"),
        "unique_merchants_24h": distinct("merchant"),
        "unique_devices_24h": distinct("device"),
        "minutes_since_last_txn": _or_none(np.minimum(minutes, MINUTES_CAP), has_last),
    }


def leaders(codes: np.ndarray, seen: np.ndarray, home: int, best: int) -> tuple[np.ndarray, int, int]:
    """The leading value before each row (-1: none), and value and count of the leader after all:
    the one that reached the largest count first. ``seen``: earlier rows of each value."""
    nth = pd.Series(codes).groupby(codes).cumcount().to_numpy() + 1 + seen[codes]
    reached = np.maximum.accumulate(np.r_[best, nth])
    leads = nth > reached[:-1]
    at = np.maximum.accumulate(np.where(leads, np.arange(len(codes)), -1))
    leader = np.where(at >= 0, codes[at], home)
    return np.r_[home, leader[:-1]], int(leader[-1]), int(reached[-1])


class UserHistory(StatefulProcessor):
    """Features of each user's rows from the state its earlier rows left."""

    def __init__(self, idle_days: int | None, cap: int, ttl: int | None):
        self.idle = idle_days * DAY_US if idle_days else None
        self.cap, self.ttl = cap, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", ARRIVAL, self.ttl)
        self.merchants = handle.getMapState("merchants", "merchant string", "rows bigint", self.ttl)
        self.countries = handle.getMapState("countries", "country string", "rows bigint", self.ttl)
        self.place = handle.getValueState("place", "history bigint, home string, best bigint", self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        arrived = pd.concat(list(rows), ignore_index=True).sort_values("arrival_order", ignore_index=True)
        us = arrived["event_us"].to_numpy(np.int64)
        stored = list(self.recent.get())
        last = stored[-1][0] if stored else us[0]
        pauses = np.diff(us, prepend=last) > self.idle if self.idle else np.zeros(len(us), bool)
        # runs of rows between pauses
        for start, end in zip([0, *np.flatnonzero(pauses)], [*np.flatnonzero(pauses), len(us)], strict=True):
            if start < end:
                yield self._history(arrived.iloc[start:end], bool(pauses[start]))

    def _history(self, rows: pd.DataFrame, anew: bool) -> pd.DataFrame:
        history, home, best = self.place.get() if self.place.exists() else (1, None, 0)
        if anew:
            history, home, best = history + 1, None, 0
            for state in (self.recent, self.merchants, self.countries):
                state.clear()
        columns = list(zip(*self.recent.get(), strict=True)) or [()] * 5
        names, kinds = ["us", "cents", "country", "merchant", "device"], [np.int64, np.int64, object, object, object]
        past = {n: np.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
        new = {
            "us": rows["event_us"].to_numpy(np.int64),
            "cents": rows["cents"].to_numpy(np.int64),
            **{n: _text(rows[c]) for n, c in (("country", "country"), ("merchant", "merchant_id"), ("device", "device_id"))},
        }
        found = look_back(past, new, self.cap)

        shops = pd.Series(new["merchant"])
        fresh = {m: not self.merchants.containsKey((m,)) for m in shops.unique()}
        found["user_merchant_first_time"] = (shops.map(fresh) & ~shops.duplicated()).tolist()
        for merchant, is_fresh in fresh.items():
            if is_fresh:
                self.merchants.updateValue((merchant,), (1,))

        lands = np.array(sorted({*new["country"].tolist(), home} - {None}), object)
        code = {c: k for k, c in enumerate(lands)}
        known = np.array([c is not None for c in new["country"]], bool)
        foreign: list = [None] * len(rows)
        if known.any():
            seen = np.array([self.countries.getValue((c,))[0] if self.countries.containsKey((c,)) else 0 for c in lands], np.int64)
            codes = np.array([code[c] for c in new["country"][known]], np.int64)
            before, leader, best = leaders(codes, seen, code.get(home, -1), best)
            for place, mine, lead in zip(np.flatnonzero(known), codes, before, strict=True):
                foreign[place] = None if lead < 0 else bool(mine != lead)
            home = lands[leader]
            for k, n in zip(*np.unique(codes, return_counts=True), strict=True):
                self.countries.updateValue((lands[k],), (int(seen[k] + n),))
        found["is_foreign_txn"] = foreign

        kept = {n: np.concatenate([past[n], new[n]])[-self.cap :].tolist() for n in names}
        self.recent.put(list(zip(*(kept[n] for n in names), strict=True)))
        self.place.update((history, home, best))
        given = {
            "transaction_id": rows["transaction_id"].tolist(),
            "user_id": rows["user_id"].tolist(),
            "event_us": rows["event_us"].tolist(),
            "history_number": [history] * len(rows),
        }
        order = [c.strip().split(" ")[0] for c in OUTPUT.split(", ")]
        frame = pd.DataFrame({n: pd.Series({**given, **found}[n], dtype=object) for n in order})
        return frame.astype({"minutes_since_last_txn": "Int64"})

    def close(self) -> None:
        pass


def stateful_features(
    rows: DataFrame, idle_days: int | None = 7, cap: int = HISTORY_CAP, ttl: int | None = None
) -> DataFrame:
    """Features of a stream of ``INPUT`` columns, one output row per input row.

    ``ttl`` (milliseconds by the clock) needs a processing-time trigger. State lies in RocksDB
    under the query's checkpoint folder; this sets the session's state store to it."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return rows.select(*INPUT).groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=UserHistory(idle_days, cap, ttl),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl else "None",
    )
