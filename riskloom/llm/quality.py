"""A quality classifier from positive and unlabelled texts.

Each text becomes some twenty shares between 0 and 1 (repeated words, capitals, symbols,
lines that end a sentence ...), each spread over a few triangular basis functions, so that
a linear function of them can bend. With the squared loss the unbiased risk

    prior * E_P[l(f) - l(-f)] + E_U[l(-f)]

depends on the texts only through first and second moments over the trusted positives P
and the unlabelled texts U. One pass over all texts gathers these (their size is fixed),
and the non-negative risk - in which the share of negatives' risk may not fall below
zero - is minimised on them. No row is drawn or dropped. (f + 1) / 2 estimates the
probability of a positive; only near 0 and 1 is it squashed, to keep the order.

The class prior is estimated from the same two kinds of texts, without any trusted negative:
above a score that hardly any negative reaches, the share of the unlabelled texts is the prior
times that of the positives. The score comes from one half of the training texts and the shares
from the other, both ways round; the score is chosen where the bound on the ratio is least.

Edge cases: null and empty texts have all shares 0 and a score like others; a null label
and a label of 0 teach nothing; several labels of one document count as a positive if any is 1; ties and
repeated rows score alike; without positives every score is 0.5;
an empty table gives an empty result; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, small_batches, stored, text_rows

KNOTS = np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.45, 1.0])
SHARES = 22
WIDTH = SHARES * (len(KNOTS) - 1) + 1  # the function of knot 0 is left to the constant
RIDGE = 1e-3
STEPS = 200
BINS = 1_000  # of the scores that the prior is read from


def text_shares(text: str) -> list[float]:
    """Shares that tell prose from lists, repetition, shouting and symbols."""
    words = text.split()
    if not words:
        return [0.0] * SHARES
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    ascii_counts = np.bincount(code[code < 128], minlength=128).astype(float)
    n, w = len(code), len(words)
    upper = float((code != low).sum()) if len(low) == n else 0.0
    letters = float(ascii_counts[65:91].sum() + ascii_counts[97:123].sum() + (code >= 192).sum())
    digits = float(ascii_counts[48:58].sum())
    white = float(ascii_counts[9:14].sum() + ascii_counts[32])
    symbols = ascii_counts.copy()
    symbols[48:58] = symbols[65:91] = symbols[97:123] = symbols[9:14] = 0
    symbols[[32, 44, 46]] = 0
    counts = Counter(words)
    top = counts.most_common(1)[0][1]
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    lengths = np.fromiter(map(len, words), np.int64, w)
    share = np.fromiter(counts.values(), float, len(counts)) / w
    entropy = float(-(share * np.log(share)).sum()) / max(np.log(w), 1.0)
    values = [
        1 - len(counts) / w,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / w,
        top / w,
        entropy,
        upper / max(letters, 1.0),
        letters / n,
        digits / n,
        white / n,
        symbols.sum() / n,
        symbols.max() / n,
        ascii_counts[33] / w,
        ascii_counts[124] / w,
        (ascii_counts[46] + ascii_counts[63]) / w,
        ascii_counts[44] / w,
        float((code[1:] == code[:-1]).mean()) if n > 1 else 0.0,
        float((lengths <= 2).mean()),
        float((lengths > 15).mean()),
        float(lengths.mean()) / 25,
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines),
        1 - len(line_counts) / len(lines),
        w / len(lines) / 200,
        np.log(w) / 12,
    ]
    return [min(1.0, max(0.0, float(v))) for v in values]


def basis(shares: np.ndarray) -> np.ndarray:
    """Rows of triangular functions of the shares, and a constant."""
    place = np.clip(np.searchsorted(KNOTS, shares, side="right") - 1, 0, len(KNOTS) - 2)
    part = (shares - KNOTS[place]) / (KNOTS[place + 1] - KNOTS[place])
    out = np.zeros((*shares.shape, len(KNOTS)))
    np.put_along_axis(out, place[..., None], (1 - part)[..., None], axis=-1)
    np.put_along_axis(out, place[..., None] + 1, part[..., None], axis=-1)
    flat = out[..., 1:].reshape(len(shares), -1)
    return np.hstack([flat, np.ones((len(shares), 1))])


@dataclass
class QualityModel:
    weights: np.ndarray
    prior: float


def share_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, shares array<double>`` of every text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shares = [text_shares(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shares, pa.list_(pa.float64()))], names=["doc_id", "shares"]
            )

    small_batches(docs.sparkSession)
    return text_rows(docs, id_col, text_col).mapInArrow(measure, "doc_id long, shares array<double>")


def _moments(rows: DataFrame) -> np.ndarray:
    """Sums of outer products of the basis, by half and by kind (all rows, positives)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2, WIDTH, WIDTH))
        for batch in batches:
            x, positive, half = _basis_rows(batch)
            for h in (0, 1):
                here, trusted = x[half == h], x[(half == h) & positive]
                sums[h, 0] += here.T @ here
                sums[h, 1] += trusted.T @ trusted
        flat = np.triu(sums).ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(flat[cells])], names=["cell", "v"])

    summed = rows.mapInArrow(gather, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(4 * WIDTH * WIDTH)
    for r in summed.collect():  # 2 * WIDTH * (WIDTH + 1) at most
        out[r["cell"]] = r["v"]
    upper = out.reshape(2, 2, WIDTH, WIDTH)
    return upper + np.triu(upper, 1).swapaxes(-1, -2)


def _basis_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = basis(np.array(batch.column("shares").to_pylist(), float).reshape(-1, SHARES))
    return x, np.array(batch.column("positive").to_pylist(), bool), np.array(batch.column("half").to_pylist(), int)


def _means(sums: np.ndarray) -> np.ndarray:
    return sums / max(float(sums[-1, -1]), 1.0)


def _score_counts(rows: DataFrame, weights: list[np.ndarray]) -> np.ndarray:
    """Rows by half, kind (all, positives) and bin of the score by the other half's weights."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 2, BINS), np.int64)
        for batch in batches:
            x, positive, half = _basis_rows(batch)
            for h in (0, 1):
                bins = score_bins(x @ weights[1 - h])
                found[h, 0] += np.bincount(bins[half == h], minlength=BINS)
                found[h, 1] += np.bincount(bins[(half == h) & positive], minlength=BINS)
        cells = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(found.ravel()[cells])], names=["cell", "n"])

    summed = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(4 * BINS, np.int64)
    for r in summed.collect():  # 4 * BINS at most
        out[r["cell"]] = r["n"]
    return out.reshape(2, 2, BINS)


def score_bins(value: np.ndarray) -> np.ndarray:
    return np.clip(((squashed((value + 1) / 2)) * BINS).astype(np.int64), 0, BINS - 1)


def best_bin_prior(unlabelled: np.ndarray, positive: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """The prior by best bin estimation, from the numbers of scores in each bin, lowest first."""
    n_u, n_p = max(1, unlabelled.sum()), max(1, positive.sum())
    above_u, above_p = unlabelled[::-1].cumsum() / n_u, positive[::-1].cumsum() / n_p
    slack = np.sqrt(np.log(4 / delta) / (2 * n_u)) + np.sqrt(np.log(4 / delta) / (2 * n_p))
    with np.errstate(divide="ignore"):
        bound = np.where(above_p > 0, (above_u + (1 + gamma) * slack) / np.where(above_p > 0, above_p, 1), np.inf)
    best = int(bound.argmin())
    return float(above_u[best] / above_p[best]) if above_p[best] else 0.5


def estimated_prior(rows: DataFrame, sums: np.ndarray) -> float:
    """The share of positives among all of ``rows``, from positives and unlabelled rows alone."""
    weights = [minimise_risk(_means(sums[h, 1]), _means(sums[h, 0]), 0.5) for h in (0, 1)]
    counts = _score_counts(rows, weights)
    halves = [(best_bin_prior(*counts[h]), counts[h, 1].sum()) for h in (0, 1) if counts[h, 1].sum()]
    if not halves:
        return 0.5
    return min(0.99, max(0.01, float(np.average([p for p, _ in halves], weights=[n for _, n in halves]))))


def minimise_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk, from the mean outer products of both kinds.

    With l(z) = (1 - z)² / 4 and x the basis (its last entry is 1)."""
    mean_p, mean_u = positive[-1], unlabelled[-1]
    ridge = RIDGE * np.eye(WIDTH)
    ridge[-1, -1] = 0

    def negative_risk(t: np.ndarray) -> float:
        all_rows = (1 + 2 * mean_u @ t + t @ unlabelled @ t) / 4
        positives = (1 + 2 * mean_p @ t + t @ positive @ t) / 4
        return all_rows - prior * positives

    curve = np.linalg.pinv(unlabelled / 2 + ridge)
    weights = curve @ (prior * mean_p - mean_u / 2)  # least unbiased risk
    for _ in range(STEPS):
        grad_positive = prior * (positive @ weights - mean_p) / 2
        grad_negative = (mean_u + unlabelled @ weights - prior * (mean_p + positive @ weights)) / 2
        kept = 1.0 if negative_risk(weights) >= 0 else -1.0  # below zero: climb back
        step = grad_positive * (kept > 0) + kept * grad_negative + ridge @ weights
        weights = weights - 0.3 * (curve @ step)
    return weights


def fit_quality(shares: DataFrame, labels: DataFrame, is_training: Column) -> QualityModel:
    """Learn from the rows of ``shares`` where ``is_training`` (a condition on ``doc_id``) holds.

    Trusted positives are those that ``labels`` (``doc_id, quality``) marks 1; all training
    texts are the unlabelled ones, and other labels are not looked at."""
    trusted = (
        labels.where(F.col("quality").cast("int") == 1)
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("positive"))
        .where(is_training)
        .distinct()
    )
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    rows = shares.where(is_training).join(trusted, "doc_id", "left")
    rows = rows.select("shares", F.coalesce("positive", F.lit(False)).alias("positive"), half)
    sums = _moments(rows)
    unlabelled, positive = sums[:, 0].sum(axis=0), sums[:, 1].sum(axis=0)
    if not positive[-1, -1]:
        return QualityModel(np.zeros(WIDTH), 0.5)
    prior = estimated_prior(rows, sums)
    return QualityModel(minimise_risk(_means(positive), _means(unlabelled), prior), prior)


def score_quality(shares: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``shares``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = basis(np.array(batch.column("shares").to_pylist(), float).reshape(-1, SHARES))
            # products of equal rows may differ in the last place
            value = np.round(squashed((x @ model.weights + 1) / 2), 12)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    scored = shares.mapInArrow(score, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def squashed(value: np.ndarray, edge: float = 0.05) -> np.ndarray:
    """The value between ``edge`` and 1 - ``edge``; beyond, it nears 0 and 1 without reaching them."""
    low = edge * np.exp(np.minimum(value - edge, 0) / edge)
    high = 1 - edge * np.exp(np.minimum(1 - edge - value, 0) / edge)
    return np.where(value < edge, low, np.where(value > 1 - edge, high, value))


def stored_shares(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shares written once, for fitting and scoring."""
    return stored(share_rows(docs, id_col, text_col))
