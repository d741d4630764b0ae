"""Tail probabilities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: Chebyshev coefficients of the complementary error function
# (Press et al., Numerical Recipes, function erfcc; relative error below 1.2e-7)
ERFC = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.5)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


MANY_DEGREES = 100


def chi2_tail(x: Column, df: Column) -> Column:
    """P(X >= x) for a chi-squared variable with ``df`` >= 1 degrees of freedom.

    Up to ``MANY_DEGREES``, even and odd degrees follow the usual finite sums, term from
    term. Beyond, the cube root of X / df is taken as normal (Wilson and Hilferty), which
    is within 1e-4 there and costs the same for any number of degrees."""
    half = x / 2
    even = df % 2 == 0
    few = F.least(df, F.lit(MANY_DEGREES))
    terms = F.floor((few - F.when(even, 0).otherwise(1)) / 2).cast("int")
    # first term: 1 (even) or sqrt(x/2)/Gamma(3/2) (odd); each next one is times half/(i + shift)
    first = F.when(even, F.lit(1.0)).otherwise(F.sqrt(half) * 2.0 / F.lit(1.7724538509055159))
    shift = F.when(even, F.lit(0.0)).otherwise(F.lit(0.5))
    start = F.struct((first * F.exp(-half)).alias("term"), F.lit(0.0).alias("sum"))
    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        steps,
        start,
        lambda acc, i: F.struct(
            (acc["term"] * half / (i + shift)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    base = F.when(even, F.lit(0.0)).otherwise(erfc(F.sqrt(half)))
    spread = F.lit(2.0) / (df * 9)
    normal = (F.cbrt(x / df) - (1 - spread)) / F.sqrt(spread)
    upper = erfc(F.abs(normal) / F.lit(1.4142135623730951)) / 2
    many = F.when(normal >= 0, upper).otherwise(1 - upper)
    return F.when(x <= 0, F.lit(1.0)).when(df > MANY_DEGREES, many).otherwise(base + total)


def kolmogorov_tail(x: Column, terms: int = 100) -> Column:
    """Asymptotic P(D * sqrt(n) >= x) of the two-sample Kolmogorov-Smirnov statistic."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def normal_two_sided(z: Column) -> Column:
    return erfc(F.abs(z) / F.lit(1.4142135623730951))
