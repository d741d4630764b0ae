"""Drift from stored summaries: small mergeable rows per day and feature, and histories of runs.

A summary row holds a feature's rows, mean, sum of squared deviations, range and bin counts of
one day, on bin edges fixed beforehand. Rows of one pass are never copied per feature: all
features are measured by one aggregate per day. Summaries of days, batches or periods merge
into those of their union, so a drift check reads a few rows per day instead of the features,
and equals the check over the rows themselves when the edges are its reference's."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import PSI_ALARM, PSI_BINS
from riskloom.functions.columns import ratio_or_zero
from riskloom.operators.drift import bin_edges, psi_of_bins, stacked

BIN_NAMES = [f"b{i}" for i in range(PSI_BINS)]
MEASURES = ["rows", "mean", "m2", "low", "high", *BIN_NAMES]


@dataclass(frozen=True)
class Edges:
    """The lower ends of a feature's bins and the upper end of the last."""

    starts: tuple[float, ...]
    high: float


def edges_table(reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """Equal bins over the reference's range: ``feature, lo, hi, step``; one row per feature."""
    return bin_edges(stacked(reference, reference.limit(0), features, fill=None))


def read_edges(edges: DataFrame) -> dict[str, Edges]:
    """The edges as numbers; the table has one row per feature."""
    return {
        r["feature"]: Edges(tuple(r["lo"] + i * r["step"] for i in range(PSI_BINS)), r["hi"]) for r in edges.collect()
    }


def summarise(rows: DataFrame, edges: dict[str, Edges], time: str = "event_time", by: Column | None = None) -> DataFrame:
    """``day, feature`` and the measures of every day and feature; NULLs count nowhere. ``by``
    takes the place of the day."""
    measures = []
    for k, (feature, edge) in enumerate(edges.items()):
        v = F.col(feature).cast("double")
        inside = v <= edge.high
        # rows from each start on; what lies in a bin is the difference of two of them
        from_start = [F.count_if(inside & (v >= s)).alias(f"_{k}_{i}") for i, s in enumerate(edge.starts)]
        measures += [
            F.count(v).alias(f"_{k}_rows"),
            F.avg(v).alias(f"_{k}_mean"),
            F.var_pop(v).alias(f"_{k}_var"),
            F.min(v).alias(f"_{k}_low"),
            F.max(v).alias(f"_{k}_high"),
            *from_start,
        ]
    day = F.to_date(time) if by is None else by
    wide = rows.groupBy(day.alias("day")).agg(*measures)

    def one(k: int, feature: str) -> Column:
        col = lambda n: F.col(f"_{k}_{n}")
        bins = [
            (col(i) - col(i + 1) if i + 1 < PSI_BINS else col(i)).alias(name) for i, name in enumerate(BIN_NAMES)
        ]
        return F.struct(
            F.lit(feature).alias("feature"),
            col("rows").alias("rows"),
            col("mean").alias("mean"),
            (col("var") * col("rows")).alias("m2"),
            col("low").alias("low"),
            col("high").alias("high"),
            *bins,
        )

    return wide.select("day", F.inline(F.array(*[one(k, f) for k, f in enumerate(edges)]))).where(F.col("rows") > 0)


def merge_summaries(summaries: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per ``by``: the summary of the union of what the given rows summarise.

    The common mean is found first and the deviations are taken from it, so that nothing
    cancels however many rows are merged."""
    whole = Window.partitionBy(*by)
    mean = F.sum(F.col("rows") * F.col("mean")).over(whole) / F.sum("rows").over(whole)
    centred = summaries.withColumn("_mean", mean)
    off = F.col("mean") - F.col("_mean")
    return centred.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("rows") * off * off).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(b).alias(b) for b in BIN_NAMES],
    )


def _side(summaries: DataFrame, side: str, keys: Sequence[str]) -> DataFrame:
    """Merged rows under the names that ``psi_of_bins`` and the drift results use."""
    short, total = ("r", "n") if side == "reference" else ("c", "m")
    std = F.when(F.col("rows") > 1, F.sqrt(F.col("m2") / (F.col("rows") - 1)))
    return summaries.select(
        *keys,
        F.col("rows").alias(total),
        F.col("mean").alias(f"{side}_mean"),
        std.alias(f"{side}_std"),
        *[F.col(b).alias(f"{short}{i}") for i, b in enumerate(BIN_NAMES)],
    )


def drift_between(summaries: DataFrame, reference: Column, current: Column) -> DataFrame:
    """Means, deviations, their change and PSI per feature between two periods, given as
    conditions on ``day``. Equals ``simple_drift`` over the rows of the periods."""
    periods = [
        _side(merge_summaries(summaries.where(period), ["feature"]), side, ["feature"])
        for period, side in ((reference, "reference"), (current, "current"))
    ]
    change = F.col("current_mean") - F.col("reference_mean")
    return periods[0].join(periods[1], "feature").select(
        "feature",
        F.col("n").alias("reference_rows"),
        F.col("m").alias("current_rows"),
        "reference_mean",
        "current_mean",
        change.alias("mean_diff"),
        (ratio_or_zero(change, F.col("reference_mean")) * 100).alias("mean_diff_pct"),
        "reference_std",
        "current_std",
        psi_of_bins().alias("psi"),
        (psi_of_bins() > PSI_ALARM).alias("drift_detected"),
    )


def drift_by_day(summaries: DataFrame, reference: Column) -> DataFrame:
    """PSI and mean of every day against one reference period: ``day, feature, ...``."""
    base = _side(merge_summaries(summaries.where(reference), ["feature"]), "reference", ["feature"])
    days = _side(merge_summaries(summaries, ["day", "feature"]), "current", ["day", "feature"])
    return days.join(base, "feature").select(  # base: one row per feature
        "day",
        "feature",
        F.col("n").alias("reference_rows"),
        F.col("m").alias("current_rows"),
        "reference_mean",
        "current_mean",
        psi_of_bins().alias("psi"),
        (psi_of_bins() > PSI_ALARM).alias("drift_detected"),
    )


def drift_history(runs: DataFrame, run: str = "run", score: str = "psi", flag: str = "drift_detected") -> DataFrame:
    """Every stored run's score of a feature beside the last run before it that has one:

    ``previous_run, previous_score, score_change``; ``drift_started``, whether the feature drifts
    and did not in that run; for a drifting feature ``drifting_since`` and ``drifting_runs``, the
    first run and the length of the unbroken drift; ``first_drift``, the first run in which
    the feature ever drifted, once there is one. A feature has one row per run."""
    along = Window.partitionBy("feature").orderBy(run)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drifts = F.coalesce(F.col(flag), F.lit(False))
    marked = runs.withColumns(
        {
            "previous_run": F.lag(run).over(along),
            "previous_score": F.lag(score).over(along),
            "drift_started": drifts & ~F.coalesce(F.lag(drifts).over(along), F.lit(False)),
            "first_drift": F.min(F.when(drifts, F.col(run))).over(so_far),
            "_at": F.row_number().over(along),
        }
    )
    begun = F.when(F.col("drift_started"), F.struct(F.col("_at").alias("at"), F.col(run).alias("run")))
    since = F.max(begun).over(so_far)
    marked = marked.withColumn("_since", F.when(drifts, since))
    return marked.select(
        run,
        "feature",
        F.col(score),
        F.col(flag),
        "previous_run",
        "previous_score",
        (F.col(score) - F.col("previous_score")).alias("score_change"),
        "drift_started",
        F.col("_since.run").alias("drifting_since"),
        (F.col("_at") - F.col("_since.at") + 1).cast("long").alias("drifting_runs"),
        "first_drift",
    )
