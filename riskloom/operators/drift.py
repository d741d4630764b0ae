"""Drift between a reference and a current set of rows.

Both sets are turned into (feature, value, in which set) and counted per distinct
value; every test is then an aggregate over those counts, some with running totals
along the values of a feature. All features are tested in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import DRIFT_FEATURES, DRIFT_THRESHOLD, PSI_ALARM, PSI_BINS, PSI_FLOOR
from riskloom.functions.columns import half_up, ratio_or_zero
from riskloom.functions.statistics import chi2_tail, kolmogorov_tail, normal_two_sided
from riskloom.operators.ordering import running_totals
from riskloom.session import stored

# fixed values: thresholds of the tests and of the dataset verdict
DISTANCE_THRESHOLD = 0.1
DATASET_SHARE = 0.5
SMALL_REFERENCE = 1_000
FEW_VALUES = 5
SMALLEST_DEVIATION = 0.001


class NoFeatures(ValueError):
    pass


def shared_features(reference: DataFrame, current: DataFrame, wanted: Sequence[str] = tuple(DRIFT_FEATURES)) -> list[str]:
    """The wanted features both sets have; raises when there are none."""
    found = [f for f in wanted if f in reference.columns and f in current.columns]
    if not found:
        raise NoFeatures("No features available for drift detection")
    return found


def stacked(reference: DataFrame, current: DataFrame, features: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Both sets as (feature, value, is_current); NULLs become ``fill`` or are dropped."""

    def long(df: DataFrame, is_current: bool) -> DataFrame:
        typed = df.select(*[F.col(f).cast("double").alias(f) for f in features])
        rows = typed.unpivot([], list(features), "feature", "value")
        rows = rows.where(F.col("value").isNotNull()) if fill is None else rows.fillna(fill, ["value"])
        return rows.withColumn("is_current", F.lit(is_current))

    return long(reference, False).unionAll(long(current, True))


def value_counts(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of each set per distinct value."""
    return long.groupBy(*by, "feature", "value").agg(
        F.count_if(~F.col("is_current")).alias("ref"), F.count_if(F.col("is_current")).alias("cur")
    )


SMALL_COUNTS = 200_000


def _along_values(counts: DataFrame) -> DataFrame:
    """Running and total rows of both sets along each feature's values. Up to
    ``SMALL_COUNTS`` distinct values one window per feature does; beyond, ordered parts."""
    counts = stored(counts)
    if counts.limit(SMALL_COUNTS + 1).count() > SMALL_COUNTS:
        return running_totals(
            counts,
            ["value"],
            {"ref": F.col("ref"), "cur": F.col("cur")},
            group=["feature"],
            following=["value"],
        )
    whole = Window.partitionBy("feature")
    along = whole.orderBy("value")
    here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns(
        {
            **{f"cum_{n}": F.sum(n).over(here) for n in ("ref", "cur")},
            **{f"total_{n}": F.sum(n).over(whole) for n in ("ref", "cur")},
            "next_value": F.lead("value").over(along),
        }
    )


def _gap() -> Column:
    """Distance of the two distribution functions at a value."""
    return F.abs(
        F.try_divide(F.col("cum_ref").cast("double"), F.col("total_ref").cast("double"))
        - F.try_divide(F.col("cum_cur").cast("double"), F.col("total_cur").cast("double"))
    )


def _test_columns() -> dict[str, Column]:
    """Every statistic of a feature, as aggregates over its value counts."""
    ref, cur, v = F.col("ref").cast("double"), F.col("cur").cast("double"), F.col("value")
    n, m = F.max("total_ref").cast("double"), F.max("total_cur").cast("double")
    mean = F.sum(ref * v) / n
    ref_std = F.sqrt(F.greatest(F.sum(ref * v * v) / n - mean * mean, F.lit(0.0)))
    p = F.try_divide(ref, F.col("total_ref").cast("double"))
    q = F.try_divide(cur, F.col("total_cur").cast("double"))
    mid = (p + q) / 2
    part = lambda a: F.when(a > 0, a * F.ln(a / mid)).otherwise(0.0)
    expected = ref * F.col("total_cur") / F.col("total_ref")
    # a value the reference never had makes the statistic infinite
    chi_term = F.when(ref > 0, (cur - expected) * (cur - expected) / expected).otherwise(
        F.lit(float("inf"))
    )
    share_ref = F.min_by(ref, v) / n
    share_cur = F.min_by(cur, v) / m
    pooled = F.min_by(ref + cur, v) / (n + m)
    z = F.try_divide(share_ref - share_cur, F.nullif(F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)), F.lit(0.0)))
    return {
        "reference_rows": F.max("total_ref"),
        "current_rows": F.max("total_cur"),
        "distinct_values": F.count(F.lit(1)),
        "ks_d": F.max(_gap()),
        "wasserstein": F.coalesce(F.sum(_gap() * (F.col("next_value") - v)), F.lit(0.0))
        / F.greatest(ref_std, F.lit(SMALLEST_DEVIATION)),
        "js_distance": F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))),
        "chi2": F.sum(chi_term),
        "z": z,
    }


def _p_values() -> dict[str, Column]:
    n, m = F.col("reference_rows").cast("double"), F.col("current_rows").cast("double")
    return {
        "ks_p": kolmogorov_tail(F.sqrt(n * m / (n + m)) * F.col("ks_d")),
        "chi2_p": F.when(F.col("distinct_values") < 2, F.lit(1.0))
        .when(F.col("chi2") == float("inf"), F.lit(0.0))
        .otherwise(chi2_tail(F.col("chi2"), F.greatest(F.col("distinct_values") - 1, F.lit(1)))),
        "z_p": F.coalesce(normal_two_sided(F.col("z")), F.lit(1.0)),
    }


def feature_tests(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """All five tests for every feature: distances, statistics and p-values."""
    features = shared_features(reference, current, features or DRIFT_FEATURES)
    return tests_from(stacked(reference, current, features))


def tests_from(long: DataFrame) -> DataFrame:
    along = _along_values(value_counts(long))
    stats = along.groupBy("feature").agg(*[c.alias(n) for n, c in _test_columns().items()])
    return stats.withColumns(_p_values())


def select_test(tests: DataFrame, p_threshold: float = DRIFT_THRESHOLD, distance_threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """The test each feature gets by reference size and number of distinct values, with
    its score, threshold and verdict."""
    few, two = F.col("distinct_values") <= FEW_VALUES, F.col("distinct_values") <= 2
    small = F.col("reference_rows") <= SMALL_REFERENCE
    name = (
        F.when(small & two, "z").when(small & few, "chi2").when(small, "ks")
        .when(few, "jensenshannon").otherwise("wasserstein")
    )
    score = (
        F.when(small & two, F.col("z_p")).when(small & few, F.col("chi2_p")).when(small, F.col("ks_p"))
        .when(few, F.col("js_distance")).otherwise(F.col("wasserstein"))
    )
    return tests.withColumns(
        {
            "stattest": name,
            "drift_score": score,
            "threshold": F.when(small, F.lit(p_threshold)).otherwise(F.lit(distance_threshold)),
            "drift_detected": F.when(small, score < p_threshold).otherwise(score >= distance_threshold),
        }
    )


def moments(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of both sets per feature."""
    of = lambda current: F.when(F.col("is_current") == current, F.col("value"))
    return long.groupBy(*by, "feature").agg(
        F.avg(of(False)).alias("reference_mean"),
        F.stddev_samp(of(False)).alias("reference_std"),
        F.avg(of(True)).alias("current_mean"),
        F.stddev_samp(of(True)).alias("current_std"),
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    p_threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Per feature: chosen test, score, verdict, means and deviations of both sets."""
    features = shared_features(reference, current, features or DRIFT_FEATURES)
    long = stacked(reference, current, features)
    chosen = select_test(tests_from(long), p_threshold)
    four = lambda c: half_up(F.nullif(F.col(c), F.lit(0.0)), 4)
    return chosen.join(moments(long), "feature").select(
        "feature",
        "drift_detected",
        half_up(F.col("drift_score"), 6).alias("drift_score"),
        "stattest",
        "threshold",
        four("reference_mean").alias("reference_mean"),
        half_up(F.col("reference_std"), 4).alias("reference_std"),
        four("current_mean").alias("current_mean"),
        half_up(F.col("current_std"), 4).alias("current_std"),
        "reference_rows",
        "current_rows",
    )


def drift_dataset(report: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """The verdict over all features of a report."""
    drifted = F.count_if(F.col("drift_detected"))
    checked = F.count(F.lit(1))
    return report.agg(
        checked.alias("features_checked"),
        drifted.alias("features_drifted"),
        ratio_or_zero(drifted, checked).alias("share_drifted"),
        F.lit(share).alias("drift_share_threshold"),
        (ratio_or_zero(drifted, checked) >= share).alias("dataset_drift"),
        F.max("reference_rows").alias("reference_rows"),
        F.max("current_rows").alias("current_rows"),
    )


# --- population stability index --------------------------------------------------


def bin_edges(long: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Per feature: low end and width of equal bins over the reference range; a constant
    reference gets a range of one around its value."""
    reference = long.where(~F.col("is_current")).groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    flat = F.col("lo") == F.col("hi")
    lo = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    hi = F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))
    return reference.select("feature", lo.alias("lo"), hi.alias("hi"), ((hi - lo) / bins).alias("step"))


def bin_number(value: Column, bins: int = PSI_BINS) -> Column:
    """0-based bin by comparison with each edge (the last bin includes its upper end);
    NULL outside the range."""
    passed = sum(
        (F.when(value >= F.col("lo") + F.lit(i) * F.col("step"), 1).otherwise(0) for i in range(1, bins)),
        start=F.lit(0),
    )
    return F.when((value >= F.col("lo")) & (value <= F.col("hi")), passed)


def psi_from(long: DataFrame, edges: DataFrame, by: Sequence[str] = (), bins: int = PSI_BINS) -> DataFrame:
    """PSI per feature. Current rows outside the reference range fall in no bin but stay
    in the denominator."""
    # edges: one row per feature, so always small
    placed = long.join(F.broadcast(edges), "feature").withColumn("bin", bin_number(F.col("value"), bins))
    of = lambda i, current: F.count_if((F.col("bin") == i) & (F.col("is_current") == current))
    counts = placed.groupBy(*by, "feature").agg(
        F.count_if(~F.col("is_current")).alias("n"),
        F.count_if(F.col("is_current")).alias("m"),
        *[of(i, False).alias(f"r{i}") for i in range(bins)],
        *[of(i, True).alias(f"c{i}") for i in range(bins)],
    )
    return counts.select(*by, "feature", psi_of_bins(bins).alias("psi"))


def psi_of_bins(bins: int = PSI_BINS) -> Column:
    floor = F.lit(PSI_FLOOR)
    total = F.lit(0.0)
    for i in range(bins):
        r = F.when(F.col(f"r{i}") == 0, floor).otherwise(F.col(f"r{i}") / F.col("n"))
        c = F.when(F.col(f"c{i}") == 0, floor).otherwise(F.col(f"c{i}") / F.col("m"))
        total = total + (c - r) * F.ln(c / r)
    return total


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None, bins: int = PSI_BINS) -> DataFrame:
    features = shared_features(reference, current, features or DRIFT_FEATURES)
    long = stacked(reference, current, features, fill=None)
    return psi_from(long, bin_edges(long, bins), bins=bins)


def simple_drift(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Means, deviations, their change and PSI per feature; NULLs are left out."""
    features = shared_features(reference, current, features or DRIFT_FEATURES)
    long = stacked(reference, current, features, fill=None)
    both = moments(long).where(F.col("reference_mean").isNotNull() & F.col("current_mean").isNotNull())
    change = F.col("current_mean") - F.col("reference_mean")
    return both.join(psi_from(long, bin_edges(long)), "feature").select(
        "feature",
        "reference_mean",
        "current_mean",
        change.alias("mean_diff"),
        (ratio_or_zero(change, F.col("reference_mean")) * 100).alias("mean_diff_pct"),
        "reference_std",
        "current_std",
        "psi",
        (F.col("psi") > PSI_ALARM).alias("drift_detected"),
    )


# --- drift over time ---------------------------------------------------------------


def drift_by_window(
    reference: DataFrame,
    rows: DataFrame,
    width: str = "1 day",
    features: Sequence[str] | None = None,
    time: str = "event_time",
    bins: int = PSI_BINS,
) -> DataFrame:
    """PSI and mean of every time window against one reference, in one pass over the rows.

    The reference is reduced to its bin edges, bin counts and means (one row per
    feature), which are joined to per-window bin counts."""
    features = shared_features(reference, rows, features or DRIFT_FEATURES)
    ref_long = stacked(reference, reference.limit(0), features, fill=None)
    edges = bin_edges(ref_long, bins)
    ref_bins = (
        ref_long.join(F.broadcast(edges), "feature")
        .withColumn("bin", bin_number(F.col("value"), bins))
        .groupBy("feature", "lo", "hi", "step")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("reference_mean"),
            *[F.count_if(F.col("bin") == i).alias(f"r{i}") for i in range(bins)],
        )
    )
    typed = rows.select(
        F.window(time, width)["start"].alias("window_start"),
        *[F.col(f).cast("double").alias(f) for f in features],
    )
    long = typed.unpivot(["window_start"], list(features), "feature", "value").where(F.col("value").isNotNull())
    counted = (
        long.join(F.broadcast(edges), "feature")
        .withColumn("bin", bin_number(F.col("value"), bins))
        .groupBy("window_start", "feature")
        .agg(
            F.count(F.lit(1)).alias("m"),
            F.avg("value").alias("current_mean"),
            *[F.count_if(F.col("bin") == i).alias(f"c{i}") for i in range(bins)],
        )
    )
    return counted.join(F.broadcast(ref_bins), "feature").select(
        "window_start",
        "feature",
        F.col("n").alias("reference_rows"),
        F.col("m").alias("current_rows"),
        "reference_mean",
        "current_mean",
        psi_of_bins(bins).alias("psi"),
        (psi_of_bins(bins) > PSI_ALARM).alias("drift_detected"),
    )


def drift_trend(by_window: DataFrame) -> DataFrame:
    """Status per run: share and number of drifted features, rows compared, worst score."""
    drifted, checked = F.count_if(F.col("drift_detected")), F.count(F.lit(1))
    return by_window.groupBy("window_start").agg(
        checked.alias("features_checked"),
        drifted.alias("features_drifted"),
        ratio_or_zero(drifted, checked).alias("share_drifted"),
        (ratio_or_zero(drifted, checked) >= DATASET_SHARE).alias("dataset_drift"),
        F.max("reference_rows").alias("reference_rows"),
        F.max("current_rows").alias("current_rows"),
        F.max("psi").alias("worst_score"),
        F.max_by("feature", "psi").alias("worst_feature"),
    )
