"""Exact quantiles of many columns by counting, without sorting or unpivoting rows.

A double's bits, with the sign bit flipped (or all bits, below zero), order like the double
itself. Each round counts, for every wanted rank at once, the values that share the bits found
so far by their next ``BITS`` bits; the bin that holds the rank gives those bits. Six rounds
find all 64. Once the bins in question hold ``FEW_VALUES`` values altogether, a round counts
whole values and is the last.

A round is one pass over the wanted columns. Batches leave as counts per bin, which Spark adds
up; what a task or the driver holds is bounded by groups x columns x bins, whatever the number
of rows. A frequent value is one count. A lost task only counts its rows again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 11
FEW_VALUES = 1 << 16
SIGN = np.uint64(1 << 63)


@dataclass
class Target:
    """Values of one column and group with the leading ``64 - left`` bits ``prefix``, and the
    ranks looked for among them: rank here -> rank in the whole group."""

    group: object
    column: str
    prefix: int = 0
    left: int = 64
    ranks: dict[int, int] = field(default_factory=dict)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; -0.0 equals 0.0, NaN is the largest."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits >= SIGN, ~bits, bits | SIGN)


def from_ordered_bits(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def _members(groups: pa.Array, group: object) -> np.ndarray:
    same = groups.is_null() if group is None else pc.fill_null(pc.equal(groups, pa.scalar(group, groups.type)), False)
    return same.to_numpy(zero_copy_only=False)


def _counter(targets: Sequence[Target], width: int, by: str) -> Callable[[Iterator], Iterator]:
    """Counts per target and next ``width`` bits, batch by batch."""

    def bins_of(target: Target, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if target.left < 64:
            key = key[key >> np.uint64(target.left) == np.uint64(target.prefix)]
        return np.unique(key >> np.uint64(target.left - width) & np.uint64((1 << width) - 1), return_counts=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            member = {g: _members(batch.column(by), g) for g in {t.group for t in targets}}
            keys, found = {}, []
            for number, t in enumerate(targets):
                if t.column not in keys:
                    values = batch.column(t.column)
                    keys[t.column] = (
                        values.is_valid().to_numpy(zero_copy_only=False),
                        ordered_bits(pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)),
                    )
                valid, key = keys[t.column]
                bins, rows = bins_of(t, key[valid & member[t.group]])
                # shifted into the signed range, so that the order stays
                found.append((np.full(len(bins), number, np.int32), (bins ^ SIGN).view(np.int64), rows.astype(np.int64)))
            arrays = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["target", "bin", "rows"])

    return count


def _round(df: DataFrame, by: str, targets: Sequence[Target], width: int) -> tuple[list[Target], bool]:
    """The targets with ``width`` more bits known, and whether they hold few values by now."""
    wanted = df.select(by, *dict.fromkeys(t.column for t in targets))
    counts = wanted.mapInArrow(_counter(targets, width, by), "target int, bin long, rows long")
    bins = counts.groupBy("target", "bin").agg(F.sum("rows").alias("rows"))
    placed = bins.selectExpr("*", "sum(rows) OVER (PARTITION BY target ORDER BY bin) - rows AS before")
    ranks = F.get(F.array(*[F.array(*[F.lit(r).cast("long") for r in t.ranks]) for t in targets]), F.col("target"))
    inside = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rows"))
    narrower = []
    for row in placed.where(F.exists(ranks, inside)).collect():
        t = targets[row["target"]]
        prefix = t.prefix << width | row["bin"] + (1 << 63)
        kept = {r - row["before"]: whole for r, whole in t.ranks.items() if 0 <= r - row["before"] < row["rows"]}
        narrower.append((Target(t.group, t.column, prefix, t.left - width, kept), row["rows"]))
    few = sum(rows for _, rows in narrower) <= FEW_VALUES
    return [t for t, _ in narrower], few


def values_at(df: DataFrame, by: str, ranks: dict[tuple[object, str], Sequence[int]], few: bool = False) -> dict:
    """(group, column, rank) -> value at that 0-based rank of the column's values in the group.

    ``few`` says that all the values together are few."""
    targets = [Target(g, c, ranks={r: r for r in rs}) for (g, c), rs in ranks.items() if rs]
    while targets and targets[0].left:
        left = targets[0].left
        targets, few = _round(df, by, targets, left if few else min(BITS, left))
    return {(t.group, t.column, r): from_ordered_bits(t.prefix) for t in targets for r in t.ranks.values()}


def selected_quantiles(
    df: DataFrame, columns: Sequence[str], by: str, fraction: float = 0.5, only_gaps: bool = False
) -> dict[object, dict[str, float | None]]:
    """{group: {column: exact interpolated quantile of its values, or None without any}}.

    ``columns`` are doubles, ``by`` has few values (such as splits); ``only_gaps`` leaves out
    columns without a NULL. The frame is read once for the counts and up to six times for the
    values: give it one that is cheap to read again."""
    if not columns:
        return {}
    totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]).collect()
    asked = [c for c in columns if not only_gaps or any(t[c] < t["_rows"] for t in totals)]
    sizes = {(t[by], c): t[c] for t in totals for c in asked if t[c]}
    at = {k: fraction * (n - 1) for k, n in sizes.items()}
    ranks = {k: sorted({int(p), min(int(p) + 1, sizes[k] - 1)}) for k, p in at.items()}
    found = values_at(df, by, ranks, sum(sizes.values()) <= FEW_VALUES)
    out = {t[by]: dict.fromkeys(asked) for t in totals}
    for (g, c), place in at.items():
        low, high = (found[g, c, ranks[g, c][i]] for i in (0, -1))
        out[g][c] = low + (high - low) * (place - int(place)) if high != low else low
    return out
