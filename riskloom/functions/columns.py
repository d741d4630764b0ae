"""Column expressions shared by batch and stream jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import BLOCK_AT, CHANNEL_CODES, REVIEW_AT


def half_up(value: Column, digits: int) -> Column:
    """Half-up rounding of a double, written so that other engines agree bit by bit."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _code(channel: Column, unknown: int) -> Column:
    code = F.lit(unknown)
    for name, number in CHANNEL_CODES.items():
        code = F.when(channel == name, F.lit(number)).otherwise(code)
    return code


def channel_code(channel: Column) -> Column:
    """Code used by the feature job: exact case, unknown is -1."""
    return _code(channel, -1)


def channel_code_for_scoring(channel: Column) -> Column:
    """Code used when scoring: any case, unknown counts as POS."""
    return _code(F.upper(channel), 0)


def calendar_columns(time: Column) -> dict[str, Column]:
    """Hour, weekday (Monday is 0), weekend and night flags of a timestamp."""
    return {
        "hour_of_day": F.hour(time),
        "day_of_week": F.weekday(time),
        "is_weekend": F.weekday(time) >= 5,
        "is_night": F.hour(time) < 6,
    }


def decision(score: Column, review_at: float = REVIEW_AT, block_at: float = BLOCK_AT) -> Column:
    return (
        F.when(score >= block_at, F.lit("BLOCK"))
        .when(score >= review_at, F.lit("REVIEW"))
        .otherwise(F.lit("APPROVE"))
    )


def rule_risk(amount: Column, channel: Column, country: Column, home: Column) -> Column:
    """Risk by fixed rules: a base rate plus a share for each rule that holds, at most 0.25."""
    # fixed values: rule thresholds and shares
    share = F.lit(0.002)
    share = share + F.when(amount >= 2000, 0.01).otherwise(0.0)
    share = share + F.when(amount >= 5000, 0.03).otherwise(0.0)
    share = share + F.when((channel == "ECOM") & (country != home), 0.05).otherwise(0.0)
    share = share + F.when((channel == "ATM") & (amount >= 1000), 0.01).otherwise(0.0)
    return F.least(share, F.lit(0.25))


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
