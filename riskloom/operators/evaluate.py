"""Evaluation of scored tables: one aggregate per distinct score, then running counts.

All curve metrics come from ``score_counts``: (group, score, positives, negatives) with
running totals from the highest score down. Areas are sums over its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import MIN_PR_AUC, MIN_RECALL_AT_5PCT_FPR
from riskloom.functions.columns import half_up, ratio_or_zero
from riskloom.operators.ordering import key_of, ranked, rows_at, running_totals

BIG = "decimal(38,0)"


def score_counts(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: its positives and negatives, those at or above it
    (``cum_pos``, ``cum_neg``), totals, and the counts of the next lower score."""
    counts = (
        scored.where(F.col("label").isNotNull())
        .groupBy(*group, "score")
        .agg(F.count_if(F.col("label")).alias("pos"), F.count_if(~F.col("label")).alias("neg"))
        .withColumn("below", -F.col("score"))
    )
    return running_totals(
        counts,
        ["below"],
        {"pos": F.col("pos"), "neg": F.col("neg")},
        group=group,
        following=["pos", "neg"],
    ).drop("below")


def _corner_only(counts: DataFrame) -> DataFrame:
    """Leave out points on a straight stretch of the ROC curve; both ends stay."""
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    return counts.where(first | last | bend)


def roc_curve(scored: DataFrame, group: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """False and true positive rate per threshold, starting at (0, 0) with an infinite one."""
    return roc_points(score_counts(scored, group), group, drop_intermediate)


def roc_points(counts: DataFrame, group: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    points = _corner_only(counts) if drop_intermediate else counts
    points = points.select(
        *group,
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        ratio_or_zero(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )
    start = _start(counts, group).select(
        *group,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def _start(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group: its highest score."""
    return counts.where(
        (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        & (F.col("pos") + F.col("neg") > 0)
    )


def pr_curve(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Precision and recall per threshold, with the (recall 0, precision 1) end point."""
    counts = score_counts(scored, group)
    points = counts.select(
        *group,
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _recall(F.col("cum_pos")).alias("recall"),
    )
    start = _start(counts, group).select(
        *group,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(start)


def _recall(found: Column) -> Column:
    # without positives every point has recall 1
    return F.when(F.col("total_pos") > 0, found / F.col("total_pos")).otherwise(F.lit(1.0))


def _roc_area() -> Column:
    """Trapezoids in whole numbers: width neg, height between old and new positives."""
    doubled = F.sum(F.col("neg").cast(BIG) * (2 * F.col("cum_pos") - F.col("pos")).cast(BIG))
    return F.try_divide(
        doubled.cast("double"), 2.0 * F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    )


def _pr_area() -> Column:
    above_pos, above_neg = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    here = F.try_divide(F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double"))
    above = F.coalesce(F.try_divide(above_pos.cast("double"), (above_pos + above_neg).cast("double")), F.lit(1.0))
    # the first point follows the (0, 1) end point
    return F.coalesce(
        F.try_divide(
            F.sum(F.col("pos").cast("double") * (here + above)), 2.0 * F.max("total_pos").cast("double")
        ),
        F.lit(0.0),
    )


def _recall_within(limit: float) -> Column:
    """Highest true positive rate at a false positive rate of at most ``limit``."""
    fpr = ratio_or_zero(F.col("cum_neg"), F.col("total_neg"))
    tpr = ratio_or_zero(F.col("cum_pos"), F.col("total_pos"))
    corner = (
        F.col("next_pos").isNull()
        | (F.col("next_pos") != F.col("pos"))
        | (F.col("next_neg") != F.col("neg"))
        | ((F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg")))
    )
    return F.coalesce(F.max(F.when((fpr <= limit) & corner, tpr)), F.lit(0.0))


def _at_threshold(threshold: Column | float) -> dict[str, Column]:
    above = F.col("score") >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    pos, neg = F.col("pos"), F.col("neg")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    tp, fp = count(F.when(above, pos).otherwise(0)), count(F.when(above, neg).otherwise(0))
    fn, tn = count(F.when(above, 0).otherwise(pos)), count(F.when(above, 0).otherwise(neg))
    return {
        "true_positives": tp,
        "false_positives": fp,
        "true_negatives": tn,
        "false_negatives": fn,
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "fpr": ratio_or_zero(fp, fp + tn),
        "fnr": ratio_or_zero(fn, fn + tp),
    }


def confusion(scored: DataFrame, threshold: float = 0.5, group: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at one threshold; a plain aggregate, no order needed."""
    rows = scored.where(F.col("label").isNotNull()).select(
        *group,
        "score",
        F.col("label").cast("int").alias("pos"),
        (~F.col("label")).cast("int").alias("neg"),
    )
    return rows.groupBy(*group).agg(*[c.alias(n) for n, c in _at_threshold(threshold).items()])


def curve_metrics(counts: DataFrame, group: Sequence[str] = (), threshold: float | Column = 0.5) -> DataFrame:
    """Every metric of a scored table from its score counts, in one aggregate."""
    columns = {
        "pr_auc": _pr_area(),
        "roc_auc": _roc_area(),
        "recall_at_1pct_fpr": _recall_within(0.01),
        "recall_at_5pct_fpr": _recall_within(0.05),
        "recall_at_10pct_fpr": _recall_within(0.10),
        **_at_threshold(threshold),
    }
    return counts.groupBy(*group).agg(*[c.alias(n) for n, c in columns.items()])


def optimal_threshold(scored: DataFrame, target_fpr: float = 0.05) -> DataFrame:
    """The curve point whose false positive rate is nearest the target (the highest
    threshold among equals), with all metrics at its threshold."""
    counts = score_counts(scored)
    best = roc_points(counts).agg(
        F.min_by(
            F.struct("threshold", "fpr", "tpr"), F.struct(F.abs(F.col("fpr") - target_fpr), -F.col("threshold"))
        ).alias("best")
    )
    found = best.first()["best"]
    if found is None:
        return curve_metrics(counts).limit(0)
    return curve_metrics(counts, threshold=F.lit(found["threshold"])).withColumns(
        {
            "optimal_threshold": F.lit(found["threshold"]),
            "actual_fpr": F.lit(found["fpr"]),
            "actual_tpr": F.lit(found["tpr"]),
        }
    )


def lift(scored: DataFrame, share: float = 0.10) -> DataFrame:
    """Positive rate among the top share of scores over the overall rate. Equal scores
    are taken in id order; a share of less than one row takes all rows."""
    rows = scored.where(F.col("label").isNotNull()).select(
        (-F.col("score")).alias("below"), "transaction_id", F.col("label").cast("int").alias("hit")
    )
    total = rows.count()
    top = int(total * share) or total
    last = rows_at(rows, ["below", "transaction_id"], [top - 1], total)
    if not last:
        return rows.agg(F.lit(0).cast("bigint").alias("top_rows"), F.lit(0.0).alias("lift"))
    here, edge = key_of(rows, last[top - 1], ["below", "transaction_id"])
    inside = here <= edge
    return rows.agg(
        F.count_if(inside).alias("top_rows"),
        ratio_or_zero(F.avg(F.when(inside, F.col("hit"))), F.avg("hit")).alias("lift"),
    )


def grouped_lift(scored: DataFrame, group: Sequence[str], share: float = 0.10) -> DataFrame:
    """``lift`` for every group at once, from ranks inside each group."""
    rows = scored.where(F.col("label").isNotNull()).select(
        *group, (-F.col("score")).alias("below"), "transaction_id", F.col("label").cast("int").alias("hit")
    )
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    tops = sizes.select(
        *group,
        F.when(F.floor(F.col("n") * share) > 0, F.floor(F.col("n") * share)).otherwise(F.col("n")).alias("top"),
    )
    placed = ranked(rows, ["below", "transaction_id"], group=group).join(tops, list(group))
    inside = F.col("_rank") < F.col("top")
    return placed.groupBy(*group).agg(
        ratio_or_zero(F.avg(F.when(inside, F.col("hit"))), F.avg("hit")).alias("lift")
    )


def evaluation_report(scored: DataFrame, group: Sequence[str] = ("split",), threshold: float = 0.5) -> DataFrame:
    """All metrics of every group as (group, metric, value)."""
    group = list(group)
    metrics = curve_metrics(score_counts(scored, group), group, threshold)
    wide = metrics.join(grouped_lift(scored, group), group)
    names = [c for c in wide.columns if c not in group]
    return wide.select(*group, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        group, names, "metric", "value"
    )


def promotion_gate(
    metrics: DataFrame, min_pr_auc: float = MIN_PR_AUC, min_recall: float = MIN_RECALL_AT_5PCT_FPR
) -> DataFrame:
    """Whether a model may be promoted, and why; being equal to a limit is enough."""
    four = lambda c: F.format_string("%.4f", half_up(c, 4))
    pr, recall = F.col("pr_auc"), F.col("recall_at_5pct_fpr")
    # fixed values: the wording of the result
    failures = F.concat_ws(
        "; ",
        F.when(pr < min_pr_auc, F.concat(F.lit("PR-AUC "), four(pr), F.lit(f" < {min_pr_auc}"))),
        F.when(recall < min_recall, F.concat(F.lit("Recall@5%FPR "), four(recall), F.lit(f" < {min_recall}"))),
    )
    passed = (pr >= min_pr_auc) & (recall >= min_recall)
    return metrics.withColumns(
        {
            "promoted": passed,
            "reason": F.when(
                passed,
                F.concat(F.lit("✅ Promoted! PR-AUC="), four(pr), F.lit(", Recall@5%FPR="), four(recall)),
            ).otherwise(F.concat(F.lit("Not promoted: "), failures)),
        }
    )


def normalised(scored: DataFrame, score: str = "score", out: str = "score_norm") -> DataFrame:
    """Scores stretched to 0..1 over the table; NULL when all scores are equal."""
    ends = scored.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    return scored.withColumn(out, F.try_divide(F.col(score) - lo, F.nullif(hi - lo, F.lit(0.0))))
