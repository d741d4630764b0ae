"""Language identification by the nearest of several centroids per language.

A text becomes a vector of letter trigrams: lower case, everything but letters one space,
log counts times inverse document frequency, unit length, hashed to ``DIMENSIONS`` places.
Document frequencies come from all training rows. Each language's vectors, a bounded sample
of its labelled rows with equal rows taken once, are clustered by cosine (spherical k-means)
into a few centroids. A text takes the language of the nearest centroid; it is rejected if it
lies farther away than nearly all (``KEPT_SHARE``) training texts of about its length by more
than a margin. A length of which fewer than ``ENOUGH`` texts were learned from is taken together
with the shorter ones; where these are too few as well, the limit is ``FEW_LIMIT`` for texts of
256 trigrams or more, and a shorter text, or any if there are fewer than ``ENOUGH`` in all, is
rejected only if it shares next to nothing with any language.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and rejected;
rows with a null language are predicted but teach nothing; ties go to the language that
sorts first; repeated rows are predicted alike; without training rows all texts are
``und`` with score 0 and only those without a letter are rejected; an empty table gives an
empty result; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import slices, small_batches, stored, text_rows, tidy
from riskloom.session import broadcast_if_small

DIMENSIONS = 1 << 13
ROWS_PER_LANGUAGE = 2_000  # different labelled rows that the clusters of one language are fitted on, at most
CENTROIDS = 4
KEPT_SHARE = 0.995
MARGIN = 0.1
ENOUGH = 100
FEW_LIMIT = 0.9
TELLING = 8  # length class of 255 trigrams
NOTHING_SHARED = 1 - 1e-3
LENGTH_CLASSES = 32

has_letter = regex.compile(r"\p{L}").search
not_letters = regex.compile(r"[^\p{L}\p{M}]+")


@dataclass
class LanguageModel:
    """What prediction needs; its size is languages × centroids × ``DIMENSIONS``."""

    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    farthest: np.ndarray  # accepted distance by length class


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of the text's trigrams (of bytes, words set off by spaces) and their counts."""
    data = np.frombuffer(f" {not_letters.sub(' ', text.lower()).strip()} ".encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    place = ((code * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int64)
    counts = np.bincount(place, minlength=DIMENSIONS)
    places = np.flatnonzero(counts)
    return places, counts[places].astype(np.float32)


def _vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts and their length classes."""
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    sizes = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        places, counts = _trigrams(text)
        weights = (1 + np.log(counts)) * idf[places]
        rows[k, places] = weights / max(float(np.sqrt(np.sum(weights * weights))), 1e-12)
        sizes[k] = int(counts.sum())
    classes = np.minimum(np.log2(sizes + 1).astype(np.int64), LENGTH_CLASSES - 1)
    return rows, classes


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training texts and, by place, of those with a trigram there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                found[_trigrams(text)[0]] += 1
                total += 1
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, places].astype(np.int32)), pa.array(np.r_[total, found[places]])],
            names=["place", "n"],
        )

    counted = rows.mapInArrow(tidy(count), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    by_place = {r["place"]: r["n"] for r in counted}
    found = np.zeros(DIMENSIONS, np.int64)
    for place, n in by_place.items():
        if place >= 0:
            found[place] = n
    return by_place.get(-1, 0), found


def _cluster(rows: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from spread-out starting rows; at most ``count`` centroids."""
    centres = rows[:1]
    while len(centres) < min(count, len(rows)):
        nearest = (rows @ centres.T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        centres = np.vstack([centres, rows[int(nearest.argmin())]])
    # a far-off start would remain alone: take the mean of all as one of the starts
    centres[0] = rows.mean(axis=0) / max(float(np.linalg.norm(rows.mean(axis=0))), 1e-12)
    for _ in range(12):
        owner = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, rows)
        size = np.linalg.norm(sums, axis=1)
        moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], centres)
        if np.allclose(moved, centres, atol=1e-5):
            break
        centres = moved
    return centres


def fit_languages(
    docs: DataFrame,
    is_training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    centroids: int = CENTROIDS,
) -> LanguageModel:
    """Learn from the rows where ``is_training`` holds that have a language and a letter."""
    small_batches(docs.sparkSession)
    rows = docs.where(is_training & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    total, found = document_frequencies(rows.select("text"))
    idf = np.log((1 + total) / (1 + found)).astype(np.float32) + np.float32(1e-3)

    keyed = rows.select("lang", "text", F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")).alias("key"))
    sample = _different(keyed, rows_per_language).select("lang", "text")

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                dense, classes = _vectors(part["text"].tolist(), idf)
                places = [np.flatnonzero(r) for r in dense]
                yield pd.DataFrame(
                    {
                        "lang": part["lang"].to_numpy(),
                        "length": classes,
                        "places": [p.astype(np.int32) for p in places],
                        "weights": [r[p] for r, p in zip(dense, places, strict=True)],
                    }
                )

    shape = "lang string, length int, places array<int>, weights array<float>"
    sample = stored(sample.mapInPandas(tidy(vectors), shape))

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(key=frame["weights"].map(lambda w: w.tobytes())).sort_values(["length", "key"])
        dense = np.zeros((len(frame), DIMENSIONS), np.float32)
        for k, (p, w) in enumerate(zip(frame["places"], frame["weights"], strict=True)):
            dense[k, p] = w
        centres = _cluster(dense, centroids)
        distance = 1 - (dense @ centres.T).max(axis=1)
        rest = [[]] * (len(centres) - 1)  # the distances stand beside the first centroid
        return pd.DataFrame(
            {
                "lang": frame["lang"].iloc[0],
                "centre": list(centres),
                "lengths": [frame["length"].to_numpy(), *rest],
                "distances": [distance, *rest],
            }
        )

    fitted = sample.groupBy("lang").applyInPandas(
        cluster, "lang string, centre array<float>, lengths array<int>, distances array<double>"
    )
    found_rows = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centre"]))
    lengths = np.array([n for r in found_rows for n in r["lengths"]], np.int64)
    distances = np.array([d for r in found_rows for d in r["distances"]], float)
    centres = np.array([r["centre"] for r in found_rows], np.float32).reshape(-1, DIMENSIONS)
    return LanguageModel(idf, [r["lang"] for r in found_rows], centres, distance_limits(lengths, distances))


def _different(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each language, by the smallest ``key``; rows with equal keys count
    once. Only keys are ranked, and of these about twice as many as are wanted."""
    keys = stored(rows.select("lang", "key").distinct())
    counts = keys.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod("key.a", F.lit(1 << 20)) < F.ceil(F.lit((2 * most + 100) * float(1 << 20)) / F.col("n"))
    by_key = Window.partitionBy("lang").orderBy(F.pmod("key.a", F.lit(1 << 20)), "key")
    ranked = keys.join(counts, "lang").where(share).withColumn("rank", F.row_number().over(by_key))
    drawn = broadcast_if_small(stored(ranked.where(F.col("rank") <= most).select("lang", "key")))
    return rows.join(drawn, ["lang", "key"]).dropDuplicates(["lang", "key"])


def distance_limits(lengths: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """The accepted distance of each length class, from those of the training texts."""
    if len(distances) < ENOUGH:
        return np.full(LENGTH_CLASSES, NOTHING_SHARED)
    limits = np.where(np.arange(LENGTH_CLASSES) < TELLING, NOTHING_SHARED, FEW_LIMIT)
    for c in range(LENGTH_CLASSES):
        for shortest in range(c, -1, -1):
            near = distances[(lengths >= shortest) & (lengths <= c)]
            if len(near) >= ENOUGH:
                limits[c] = float(np.quantile(near, KEPT_SHARE)) + MARGIN
                break
    # a shorter text is never held to a stricter limit than a longer one
    return np.minimum(np.maximum.accumulate(limits[::-1])[::-1], NOTHING_SHARED)


def predict_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, distance, rejected``: score is the cosine with the nearest centroid."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for at in range(0, batch.num_rows, 256):
                yield _predicted(batch.slice(at, 256), model)

    small_batches(docs.sparkSession)
    return text_rows(docs, id_col, text_col).mapInArrow(
        tidy(predict), "doc_id long, lang_pred string, score double, distance double, rejected boolean"
    )


def _predicted(batch: pa.RecordBatch, model: LanguageModel) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    letters = np.array([bool(has_letter(t)) for t in texts], bool)
    names = np.full(len(texts), "und", object)
    best = np.zeros(len(texts))
    rejected = ~letters
    if len(model.languages):
        rows, classes = _vectors([t if ok else "" for t, ok in zip(texts, letters, strict=True)], model.idf)
        near = rows @ model.centroids.T
        pick = near.argmax(axis=1)
        names = np.where(letters, np.array(model.languages, object)[pick], "und")
        best = np.where(letters, np.clip(near[np.arange(len(texts)), pick].astype(np.float64), 0, 1), 0.0)
        rejected = rejected | (1 - best > model.farthest[classes])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(names.tolist(), pa.string()),
            pa.array(best),
            pa.array(1 - best),
            pa.array(rejected),
        ],
        names=["doc_id", "lang_pred", "score", "distance", "rejected"],
    )
