"""Explanations of a score: contributions, descriptions, risk factors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import FEATURE_TEXT, MODEL_FEATURES, REVIEW_AT, TOP_K
from riskloom.functions.columns import half_up

FLAGS = ["country_change_flag", "device_change_flag", "user_merchant_first_time", "is_weekend", "is_night"]


def _money(value: Column) -> Column:
    return F.format_string("%,.2f", half_up(value, 2))


def _tenth(value: Column) -> Column:
    return F.format_string("%.1f", half_up(value, 1))


def _whole(value: Column) -> Column:
    return value.cast("bigint").cast("string")


def _number(value: Column) -> Column:
    """A double as plain text, also beyond the point where Spark turns to exponents."""
    plain = (F.abs(value) < 1e7) & ((F.abs(value) >= 1e-3) | (value == 0))
    return F.when(plain, value.cast("string")).otherwise(F.format_string("%.2f", value))


def describe(name: str, value: Column) -> Column:
    """The text for one feature value (a double)."""
    either = lambda yes, no: F.when(value != 0, F.lit(yes)).otherwise(F.lit(no))
    text = F.concat
    # fixed values: wording and value bands of the descriptions
    if name == "country_change_flag":
        return either("Country changed from previous transaction", "Same country as previous")
    if name == "device_change_flag":
        return either("Different device from previous transaction", "Same device as previous")
    if name == "user_merchant_first_time":
        return either("First time shopping at this merchant", "Known merchant")
    if name == "is_weekend":
        return either("Weekend transaction", "Weekday transaction")
    if name == "is_night":
        return either("Night-time transaction (midnight-6am)", "Daytime transaction")
    if name == "amount":
        return text(F.lit("Transaction amount: $"), _money(value))
    if name == "amount_zscore":
        return (
            F.when(value > 3, text(F.lit("Amount is "), _tenth(value), F.lit(" std devs above user average (very unusual)")))
            .when(value > 2, text(F.lit("Amount is "), _tenth(value), F.lit(" std devs above user average (unusual)")))
            .when(value < -2, text(F.lit("Amount is "), _tenth(F.abs(value)), F.lit(" std devs below user average")))
            .otherwise(text(F.lit("Amount is typical for this user (z-score: "), _tenth(value), F.lit(")")))
        )
    if name == "user_txn_count_1h":
        return F.when(
            value > 5, text(F.lit("High velocity: "), _whole(value), F.lit(" transactions in last hour"))
        ).otherwise(text(_whole(value), F.lit(" transaction(s) in last hour")))
    if name == "user_txn_count_24h":
        return text(_whole(value), F.lit(" transaction(s) in last 24 hours"))
    if name == "minutes_since_last_txn":
        return (
            F.when(value.isNull() | (value > 10000), F.lit("First transaction in a while"))
            .when(value < 5, text(F.lit("Only "), _whole(value), F.lit(" minutes since last transaction (rapid)")))
            .otherwise(text(_whole(value), F.lit(" minutes since last transaction")))
        )
    if name == "unique_countries_24h":
        return F.when(
            value > 2, text(F.lit("Used in "), _whole(value), F.lit(" different countries in 24h (suspicious)"))
        ).otherwise(text(F.lit("Used in "), _whole(value), F.lit(" country/countries in 24h")))
    if name == "channel_encoded":
        channel = (
            F.when(value == 0, "POS (in-store)").when(value == 1, "ECOM (online)").when(value == 2, "ATM")
            .otherwise(text(F.lit("Channel "), _whole(value)))
        )
        return text(F.lit("Transaction channel: "), channel)
    if name == "hour_of_day":
        return text(F.lit("Transaction at "), F.lpad(_whole(value), 2, "0"), F.lit(":00"))
    return text(F.lit(FEATURE_TEXT.get(name, name) + ": "), _number(value))


def contributions(
    importances: Mapping[str, float],
    columns: Sequence[str] = tuple(MODEL_FEATURES),
    top_k: int | None = TOP_K,
    boolean_full_weight: bool = False,
) -> Column:
    """The features that weigh most in a row, as an array of
    (feature, value, contribution, description), heaviest first.

    A contribution is importance times the value's size over 100, at most 1; equal ones
    keep the column order. ``boolean_full_weight`` gives a set flag its whole importance.
    """
    names = [n for n in columns if n in importances]
    parts = []
    for position, name in enumerate(names):
        value = F.col(name).cast("double")
        weight = F.least(F.abs(value) / 100.0, F.lit(1.0))
        if boolean_full_weight and name in FLAGS:
            weight = (value != 0).cast("double")
        contribution = half_up(F.lit(float(importances[name])) * weight, 4)
        parts.append(
            F.struct(
                (-contribution).alias("order"),
                F.lit(position).alias("position"),
                F.lit(name).alias("feature"),
                value.alias("value"),
                contribution.alias("contribution"),
            )
        )
    ordered = F.array_sort(F.array(*parts))
    if top_k is not None:
        ordered = F.slice(ordered, 1, top_k)

    def finished(p: Column) -> Column:
        # texts are written for the rows that stay, not for every column
        text = F.lit(None).cast("string")
        for position, name in reversed(list(enumerate(names))):
            text = F.when(p["position"] == position, describe(name, p["value"])).otherwise(text)
        return F.struct(
            p["feature"].alias("feature"),
            p["value"].alias("value"),
            p["contribution"].alias("contribution"),
            text.alias("description"),
        )

    return F.transform(ordered, finished)


def risk_factors(score: Column, review_at: float = REVIEW_AT) -> Column:
    """Plain-language reasons for concern, in fixed order; one catch-all when the score
    is above the review cut-off and no rule holds."""
    c = F.col
    set_ = lambda name: F.coalesce(c(name).cast("int"), F.lit(0)) != 0
    text = F.concat
    # fixed values: rules and wording of the risk factors
    rules = [
        F.when(c("amount") > 2000, text(F.lit("High transaction amount ($"), _money(c("amount")), F.lit(")"))),
        F.when(
            c("amount_zscore") > 3,
            text(F.lit("Amount is unusually high for this user ("), _tenth(c("amount_zscore")), F.lit(" std devs)")),
        ),
        F.when(set_("country_change_flag"), F.lit("Different country from previous transaction")),
        F.when(
            c("unique_countries_24h") > 2,
            text(F.lit("Card used in "), _whole(c("unique_countries_24h")), F.lit(" countries in 24 hours")),
        ),
        F.when(
            c("user_txn_count_1h") > 5,
            text(F.lit("High transaction velocity ("), _whole(c("user_txn_count_1h")), F.lit(" in last hour)")),
        ),
        F.when(
            c("minutes_since_last_txn") < 5,
            text(F.lit("Rapid transaction ("), _whole(c("minutes_since_last_txn")), F.lit(" minutes since last)")),
        ),
        F.when(set_("device_change_flag"), F.lit("New device detected")),
        F.when(set_("user_merchant_first_time"), F.lit("First transaction at this merchant")),
        F.when(c("channel_encoded") == 1, F.lit("Online transaction (card-not-present)")),
        F.when(set_("is_night"), F.lit("Transaction during night hours (midnight-6am)")),
    ]
    found = F.array_compact(F.array(*rules))
    return (
        F.when(F.size(found) > 0, found)
        .when(score > review_at, F.array(F.lit("Multiple moderate risk factors combined")))
        .otherwise(F.array().cast("array<string>"))
    )
