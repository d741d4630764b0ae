"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman scores them.

Every text is a sequence of word hashes (letters and digits, lower case). Seeds are pairs of words
that follow each other directly or with one word between them. An alignment scores 1 for a match
and -``PENALTY`` for a mismatch or a gap; the best local score over the item's number of words n
is the leak's score. Between two matches that are no seed lie at least ``SPAN`` mismatches or gaps,
so a leak with m matches and s seeds has (m - 1 - s) ``SPAN`` ``PENALTY`` <= m - ``threshold`` n;
as ``SPAN`` ``PENALTY`` = 1, s >= ``threshold`` n - 1. At least that many places of the item are
therefore the first word of a seed that the document holds too, whatever was edited.

So the most frequent places of an item can be left out: with all but (``threshold`` n - 1 - ``HITS``)
of them as seeds, rarest in the corpus first, a leak still hits ``HITS`` different places (fewer
for short items). Nothing with a score of ``threshold`` is lost for items of three words or more.
Shorter items are looked for by all their words.

Three passes over the documents, however long the benchmark: counts of the seeds, hits of the rare
seeds, and alignment of the documents that remain. A pass tests its pairs against a bitmap of
fixed size, then Spark joins the hits to the seeds; hits count only where they lie as close as a
leak may reach. The joins broadcast the benchmark's side up to ``BROADCAST_WORDS`` words of it;
beyond, each seed is copied to ``SALT`` keys, so that a passage held by a third of all documents is
spread. Texts travel only for documents that remain.

Edge cases: null and empty texts, items without a word and rows with a null id leak nothing; equal
items and equal rows are reported each and once; several rows of one id are texts of one document
(or item) and report the best; ties report the earlier passage; very long texts are searched whole;
empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, small_batches, stored, text_rows, tidy
from riskloom.llm.packed import BASE, SLICE_BYTES, mix
from riskloom.session import broadcast_if_small

SPAN = 2
PENALTY = 0.5
THRESHOLD = 0.4
HITS = 4
BROADCAST_WORDS = 500_000
SALT = 16
BITMAP_BITS = 26
REMEMBERED_WORDS = 1 << 17

# letters and digits stay, and all bytes of other scripts; the rest parts words
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class _WordHashes(dict):
    """Hashes of words; the first ``REMEMBERED_WORDS`` short ones are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED_WORDS and len(word) <= 32:
            self[word] = value
        return value


_hashes = _WordHashes()


def word_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text's place, hash) of all words: runs of letters and digits, in lower case."""
    words = [t.lower().encode("utf-8").translate(WORD_BYTES).split() for t in texts]
    counts = [len(w) for w in words]
    found = [np.fromiter(map(_hashes.__getitem__, w), np.uint64, n) for w, n in zip(words, counts, strict=True)]
    return np.repeat(np.arange(len(texts)), counts), np.concatenate([np.empty(0, np.uint64), *found])


def seed_codes(owner: np.ndarray, hashes: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, code) of all pairs up to ``SPAN`` apart, in each text.

    ``single`` adds the codes of single words, the seeds of one-word items."""
    places, codes = [], []
    for gap in range(1, SPAN + 1):
        at = np.flatnonzero(owner[gap:] == owner[:-gap])
        places.append(at)
        codes.append(mix(hashes[at] * BASE + hashes[at + gap]))
    if single:
        places.append(np.arange(len(hashes)))
        codes.append(mix(hashes ^ BASE))
    return np.concatenate(places), np.concatenate(codes)


def seeds_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, code) of an item's seeds."""
    if len(words) == 1:
        return np.zeros(1, np.int64), mix(words ^ BASE)
    return seed_codes(np.zeros(len(words), np.int64), words)


def align(item: np.ndarray, passage: np.ndarray, penalty: float = PENALTY) -> tuple[float, int]:
    """Best local alignment score and the place in the passage where it ends.

    Gaps in the passage's direction are a running maximum, so each item word is one pass."""
    n = len(passage)
    slope = penalty * np.arange(n + 1)
    row, best, end = np.zeros(n + 1), 0.0, 0
    for word in item:
        fresh = np.zeros(n + 1)
        fresh[1:] = np.maximum(row[:-1] + np.where(passage == word, 1.0, -penalty), row[1:] - penalty)
        np.maximum(fresh, 0.0, out=fresh)
        row = np.maximum.accumulate(fresh + slope) - slope
        top = int(row.argmax())
        if row[top] > best + 1e-12:
            best, end = float(row[top]), top
    return best, end


def reach(n: int, threshold: float) -> int:
    """Words a leak of an item of ``n`` words spans at most: with m matches and p mismatches and
    gaps, m - ``PENALTY`` p >= ``threshold`` n, so n + p <= n + (1 - ``threshold``) n / ``PENALTY``."""
    return n + int(max(0.0, 1 - threshold) * n / PENALTY) + 1


def alive(n: Column, threshold: float) -> Column:
    """Places of an item of ``n`` words that are a seed in every leak, at least."""
    return F.greatest(F.lit(1), F.ceil(n * threshold - 1 - 1e-9)).cast("int")


# --- items and their seeds -----------------------------------------------------------

ITEM = "item long, item_id long, words array<long>, places array<int>, codes array<long>"


def _read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, hashes = word_table(batch.column("text").to_pylist())
        edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        words = [hashes[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        seeds = [seeds_of(w) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item"),
                batch.column("item_id"),
                pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())),
                pa.array([p.astype(np.int32) for p, _ in seeds], pa.list_(pa.int32())),
                pa.array([c.view(np.int64) for _, c in seeds], pa.list_(pa.int64())),
            ],
            names=["item", "item_id", "words", "places", "codes"],
        )


def read_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (a number of its own), ``item_id, words, places, codes`` of items with a word."""
    rows = text_rows(items, id_col, text_col).where("doc_id IS NOT NULL")
    named = rows.select(F.monotonically_increasing_id().alias("item"), F.col("doc_id").alias("item_id"), "text")
    return stored(named.mapInArrow(tidy(_read_items), ITEM).where(F.size("words") > 0))


def rare_seeds(seeds: DataFrame, counts: DataFrame, threshold: float) -> DataFrame:
    """The seeds ``code, item, place, n`` of the places that are looked for, with ``need``, the
    different places a leak hits. Places are ranked by how often the documents hold their seeds."""
    often = seeds.join(counts, "code", "left").groupBy("item", "place").agg(
        F.sum(F.coalesce("often", F.lit(0))).alias("often"), F.first("n").alias("n"), F.collect_set("code").alias("codes")
    )
    # one row per item and place: an item's places are at most its words
    ranked = often.selectExpr("*", "row_number() OVER (PARTITION BY item ORDER BY often, place) AS rank")
    sure = alive(F.col("n"), threshold)
    need = F.least(F.lit(HITS), sure)
    kept = ranked.where(F.col("rank") <= F.greatest(F.col("n") - 1, F.lit(1)) - (sure - need))
    return kept.select(F.explode("codes").alias("code"), "item", "place", "n", need.alias("need"))


def bitmap(seeds: DataFrame) -> np.ndarray:
    """A bit for the leading ``BITMAP_BITS`` bits of every code: 8 MB, however many codes."""
    bit = F.shiftrightunsigned("code", 64 - BITMAP_BITS)
    cells = seeds.select(F.shiftright(bit, 15).alias("cell"), bit.bitwiseAND(F.lit((1 << 15) - 1)).alias("bit"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in cells.groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[row["cell"] << 12 : (row["cell"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return out


def in_bitmap(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of the codes whose bit is set."""
    at = codes >> np.uint64(64 - BITMAP_BITS)
    return np.flatnonzero(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)


# --- passes over the documents ---------------------------------------------------------


def _count(shared, single: bool) -> Callable[[Iterator], Iterator]:
    """How often each seed that the bitmap lets through occurs, slice by slice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES):
            _, codes = seed_codes(*word_table(batch.column("text").to_pylist()), single)
            code, often = np.unique(codes[in_bitmap(shared.value, codes)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(often)], names=["code", "often"])

    return count


def _find(shared, single: bool) -> Callable[[Iterator], Iterator]:
    """The places of the seeds that the bitmap lets through."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES):
            owner, hashes = word_table(batch.column("text").to_pylist())
            places, codes = seed_codes(owner, hashes, single)
            hit = in_bitmap(shared.value, codes)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            text = owner[places[hit]]
            at = places[hit] - np.searchsorted(owner, np.arange(len(ids)))[text]
            columns = [ids[text], at, codes[hit].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "at", "code"])

    return find


def _joined(many: DataFrame, few: DataFrame, key: str, small: bool) -> DataFrame:
    """``many`` (with ``doc_id``) joined to the benchmark's side; a frequent key is spread."""
    if small:
        return many.join(F.broadcast(few), key)
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    spread = many.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
    return spread.join(copies, [key, "_salt"]).drop("_salt")


def candidates(hits: DataFrame, seeds: DataFrame, threshold: float, small: bool) -> DataFrame:
    """``doc_id, item`` with enough different places of the item hit within a leak's reach.

    Cells are two reaches wide, on two grids one reach apart, so any leak lies in one of them."""
    half = F.col("n") + F.floor(F.col("n") * max(0.0, 1 - threshold) / PENALTY) + 1
    cells = F.array(
        2 * F.floor(F.col("at") / (2 * half)), 2 * F.floor((F.col("at") + half) / (2 * half)) + 1
    )
    near = _joined(hits, seeds, "code", small).select("doc_id", "item", "need", "place", F.explode(cells).alias("cell"))
    places = near.groupBy("doc_id", "item", "cell").agg(F.size(F.collect_set("place")).alias("hit"), F.first("need").alias("need"))
    return places.where("hit >= need").select("doc_id", "item").distinct()


# --- alignment ---------------------------------------------------------------------------


def _shared(target: np.ndarray, passage: np.ndarray) -> int:
    """Words the two have in common, each as often as both hold it: no alignment scores more."""
    words, most = np.unique(target, return_counts=True)
    at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
    held = np.bincount(at[words[at] == passage], minlength=len(words))
    return int(np.minimum(held, most).sum())


def best_passage(
    words: np.ndarray, order: np.ndarray, places: np.ndarray, codes: np.ndarray, target: np.ndarray, threshold: float
) -> tuple[float, int]:
    """Best alignment of the item ``target`` with a text, and the word where it ends.

    ``codes[order]`` ascends. Only passages with as many seeds as a leak has at least are aligned;
    passages close together are one."""
    seeds = np.unique(seeds_of(target)[1])
    low = np.searchsorted(codes[order], seeds, side="left")
    high = np.searchsorted(codes[order], seeds, side="right")
    hits = np.unique(np.concatenate([places[order[a:b]] for a, b in zip(low, high, strict=True)]))
    far = reach(len(target), threshold)
    sure = max(1, int(np.ceil(threshold * len(target) - 1 - 1e-9)))
    end = np.searchsorted(hits, hits + far)
    dense = np.flatnonzero(end - np.arange(len(hits)) >= sure)
    steps = np.bincount(dense, minlength=len(hits) + 1) - np.bincount(end[dense], minlength=len(hits) + 1)
    hits = hits[np.cumsum(steps[:-1]) > 0]
    best, last = 0.0, 0
    for group in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * far) + 1) if len(hits) else ():
        a, b = max(0, int(group[0]) - far), int(group[-1]) + SPAN + far
        if _shared(target, words[a:b]) < threshold * len(target):
            continue
        score, place = align(target, words[a:b])
        if score > best + 1e-12:
            best, last = score, a + place
    return best, last


LEAK = "doc_id long, item_id long, score double, n_item_words long, end_word long"


def _align(threshold: float) -> Callable[[Iterator], Iterator]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: str | None = None  # the items of a document follow each other
        for batch in slices(batches, SLICE_BYTES):
            rows = []
            targets = batch.column("words")
            for k, (doc_id, text, item_id) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "item_id")), strict=True)
            ):
                if text != held:
                    held, (owner, words) = text, word_table([text])
                    places, codes = seed_codes(owner, words, single=True)
                    order = np.argsort(codes)
                target = targets[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                best, end = best_passage(words, order, places, codes, target, threshold)
                if best >= threshold * len(target):
                    rows.append((doc_id, item_id, best / len(target), len(target), end))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "score", "n_item_words", "end_word"],
            )

    return search


def leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, n_item_words, end_word`` of each document and item it leaks."""
    spark = docs.sparkSession
    small_batches(spark)
    share = spark.sparkContext.broadcast
    texts = text_rows(docs, id_col, text_col).where("doc_id IS NOT NULL")
    tests = read_items(items, item_id_col, item_text_col)
    size = tests.agg(F.sum(F.size("words")).alias("words"), F.min(F.size("words")).alias("least")).first()
    if size["words"] is None:
        return spark.createDataFrame([], LEAK)
    small, single = size["words"] <= BROADCAST_WORDS, size["least"] == 1

    seeds = tests.select("item", F.size("words").alias("n"), F.explode(F.arrays_zip("places", "codes")).alias("s"))
    seeds = seeds.select("item", "n", F.col("s.places").alias("place"), F.col("s.codes").alias("code"))
    found = texts.select("text").mapInArrow(tidy(_count(share(bitmap(seeds)), single)), "code long, often long")
    counts = found.groupBy("code").agg(F.sum("often").alias("often"))
    rare = stored(rare_seeds(seeds, counts, threshold))

    hits = texts.mapInArrow(tidy(_find(share(bitmap(rare)), single)), "doc_id long, at long, code long")
    pairs = stored(candidates(hits, rare, threshold, small))

    ids = broadcast_if_small(stored(pairs.select("doc_id").distinct()))
    pairs = _joined(pairs, tests.select("item", "item_id", "words"), "item", small)
    rows = texts.join(ids, "doc_id", "left_semi").join(pairs, "doc_id")
    aligned = rows.select("doc_id", "text", "item_id", "words").mapInArrow(tidy(_align(threshold)), LEAK)
    best = F.max_by(F.struct("score", "n_item_words", "end_word"), F.struct("score", -F.col("end_word")))
    return aligned.groupBy("doc_id", "item_id").agg(best.alias("l")).select("doc_id", "item_id", "l.*")
