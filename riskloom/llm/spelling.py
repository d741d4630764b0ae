"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Every word is a vector of letter counts. Two words one edit apart have vectors at a squared
distance of at most two: a replaced letter changes two counts by one, an inserted letter one.
Squared distances of whole blocks of words come from one NumPy product of their count
matrices; pairs at most two apart are then verified letter by letter.

Blocks: the counts of six fixed letter classes name a word's cell; their sum is its length,
so a cell lies in one length. An edit moves a word to its own cell, to a cell with one class
count raised (the next length) or with one raised and one lowered (the same length). Only
such cells are multiplied, each unordered pair of blocks once. A cell with many words is cut
into blocks by a hash, so a task never holds more than two blocks.

Edge cases: null and empty texts have no words; words of any length are taken whole; a null
id counts as an empty one where an id picks the letter to drop; repeated rows count each;
equal counts among near words are settled by code-point order; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, stored, tidy

# fixed values: the runs that are words, and the letters that are lower-cased
RUNS = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CLASSES = 6
# letters by how frequent they are, dealt to the classes in turn; all others make up the last class
BY_FREQUENCY = "enatiorhuscldgbfzmwyxqvpkj"
BLOCK_WORDS = 1_024
BLOCK_LETTERS = 1 << 20
GATHERED = 4_096  # words multiplied with a block at once


def word_counts(
    docs: DataFrame, noise: int | None = 97, least_length: int = 5, least_rows: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, n``: the words of all texts with their occurrences.

    ``noise`` drops a letter from every run whose crc32 with its document's id it divides
    (None: no letter is dropped)."""
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(key.alias("key"), F.explode(F.regexp_extract_all(lowered, F.lit(RUNS), 1)).alias("word"))
    if noise is not None:
        picked = F.crc32(F.concat("key", "word").cast("binary"))
        at = (picked % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.select(F.when(picked % noise == 0, cut).otherwise(F.col("word")).alias("word"))
    counts = runs.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= least_length) & (F.col("n") >= least_rows))


def _class_counts(word: Column) -> list[Column]:
    """How many letters of each class a word holds."""
    counts = []
    for k in range(CLASSES - 1):
        letters = BY_FREQUENCY[k :: CLASSES - 1]
        counts.append(F.length(word) - F.length(F.translate(word, letters, "")))
    return [*counts, F.length(F.translate(word, BY_FREQUENCY, ""))]


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def _centres(counts: list[Column]) -> Column:
    """The cells whose words one edit may turn into words of this cell: one count less, or
    one less and a later one more. A cell and its centres name each pair of cells once."""
    found = []
    for i in range(CLASSES):
        less = [c - 1 if k == i else c for k, c in enumerate(counts)]
        found.append(F.when(counts[i] > 0, _key(less)))
        for j in range(i + 1, CLASSES):
            moved = [c + 1 if k == j else c for k, c in enumerate(less)]
            found.append(F.when(counts[i] > 0, _key(moved)))
    return F.array_compact(F.array(*found))


def _blocks(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cell, c (class counts), block, words`` and, per cell, its number of ``blocks``."""
    placed = words.withColumn("c", F.array(*_class_counts(F.col("word"))))
    placed = placed.withColumn("cell", _key([F.col("c")[k] for k in range(CLASSES)]))
    size = F.greatest(F.count(F.lit(1)) / BLOCK_WORDS, F.sum(F.length("word")) / BLOCK_LETTERS)
    cells = stored(placed.groupBy("cell").agg(F.ceil(size).cast("int").alias("blocks")))
    dealt = placed.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    blocks = dealt.groupBy("cell", "block").agg(
        F.first("c").alias("c"), F.collect_list(F.struct("word", "n")).alias("words")
    )
    return blocks, cells


def _meetings(words: DataFrame) -> DataFrame:
    """``cell, block, side, own, words``: for every block (side 0) the blocks it is multiplied
    with (side 1): later blocks of its cell and all blocks of the cells around it."""
    blocks, cells = _blocks(words)
    blocks = stored(blocks)
    counts = [F.col("c")[k] for k in range(CLASSES)]
    first = blocks.select("cell", "block", F.lit(0).alias("side"), "words")
    around = blocks.select(F.explode(_centres(counts)).alias("cell"), "words").join(cells, "cell")
    around = around.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "words")
    within = blocks.where("block > 0").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("block"), F.lit(1).alias("side"), "words"
    )
    return first.unionByName(around).unionByName(within)


class Words:
    """Words with their letter counts and letters as arrays. All letters are below U+0100."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        row = np.repeat(np.arange(len(words)), self.lengths)
        counts = np.bincount(row * 256 + letters, minlength=256 * len(words)).reshape(-1, 256)
        # counts up to 1,000 give sums that a 32-bit float holds exactly
        self.counts = counts.astype(np.float32 if self.lengths.max() < 1_000 else np.float64)
        self.squares = np.einsum("ij,ij->i", self.counts, self.counts)
        self.letters = np.zeros((len(words), int(self.lengths.max())), np.uint8)
        self.letters[row, np.arange(len(letters)) - np.repeat(starts, self.lengths)] = letters


def near_pairs(a: Words, b: Words, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of words one edit apart; words of ``b`` are as long as those
    of ``a`` or one longer. ``same``: both are one block, and each pair is wanted once."""
    used = np.flatnonzero(a.counts.any(axis=0))
    product = a.counts[:, used] @ b.counts[:, used].T
    distance = a.squares[:, None] + b.squares[None, :] - 2 * product
    i, j = np.nonzero(distance <= 2)
    if same:
        keep = i < j
        i, j = i[keep], j[keep]
    near = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):  # a bounded number of pairs at once
        part = slice(at, at + (1 << 16))
        near[part] = _one_edit(a, b, i[part], j[part])
    return i[near], j[near]


def _one_edit(a: Words, b: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    near = np.zeros(len(i), bool)
    length, longer = a.lengths[i], b.lengths[j]
    width = a.letters.shape[1]
    other = np.zeros((len(b.words), width + 1), np.uint8)
    other[:, : min(width + 1, b.letters.shape[1])] = b.letters[:, : width + 1]
    replaced = length == longer
    near[replaced] = (a.letters[i[replaced]] != other[j[replaced], :width]).sum(axis=1) == 1
    grown = np.flatnonzero(longer == length + 1)
    short, long = a.letters[i[grown]], other[j[grown]]
    inside = np.arange(width) < length[grown, None]
    # equal letters from the front, and from the back when the longer word's first letter is passed over
    front = np.cumprod((short == long[:, :width]) & inside, axis=1).sum(axis=1)
    shifted = (short == long[:, 1:]) | ~inside
    back = np.cumprod(shifted[:, ::-1], axis=1).sum(axis=1) - (width - length[grown])
    near[grown] = front + back >= length[grown]
    return near


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of blocks that arrive in order of (cell, block, side)."""
    key, block = None, None
    words: list[str] = []
    counts: list[np.ndarray] = []

    def found(a: Words, b: Words, same: bool = False) -> Iterator[pa.RecordBatch]:
        i, j = near_pairs(a, b, same)
        if len(i):
            left, right = pa.array(a.words).take(pa.array(i)), pa.array(b.words).take(pa.array(j))
            n, m = pa.array(a.n[i]), pa.array(b.n[j])
            names = ["word", "near", "n"]
            yield pa.RecordBatch.from_arrays([left, right, m], names=names)
            yield pa.RecordBatch.from_arrays([right, left, n], names=names)

    def flush() -> Iterator[pa.RecordBatch]:
        if words:
            yield from found(block, Words(words, np.concatenate(counts)))
            words.clear()
            counts.clear()

    for batch in batches:
        listed = batch.column("words")
        flat = listed.flatten()
        spelled, n = flat.field("word"), flat.field("n").to_numpy()
        ends = np.cumsum(pa.compute.list_value_length(listed).to_numpy())
        rows = zip(batch.column("cell").to_pylist(), batch.column("block").to_pylist(), batch.column("side").to_pylist(), strict=True)
        for row, (cell, number, side) in enumerate(rows):
            start, end = (ends[row - 1] if row else 0), ends[row]
            here = spelled.slice(start, end - start).to_pylist()
            if side == 0:
                yield from flush()
                key, block = (cell, number), Words(here, n[start:end])
                yield from found(block, block, same=True)
            elif key == (cell, number):
                words += here
                counts.append(n[start:end])
                if len(words) >= GATHERED:
                    yield from flush()
    if block is not None:
        yield from flush()


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, n``: every ordered pair of words one edit apart, with the near word's ``n``.
    ``words`` holds distinct ``word`` of letters below U+0100, with ``n``."""
    small_batches(words.sparkSession)
    met = _meetings(words).repartition("cell", "block").sortWithinPartitions("cell", "block", "side")
    return met.mapInArrow(tidy(_multiply), "word string, near string, n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last. A form has at least twice its word's count, so
    paths end; each round doubles the steps made."""
    at = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not at.where("moved").limit(1).isEmpty():
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = at.join(onward, "root", "left")
        at = stored(stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return at.select("word", "root")


def variant_groups(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: each word's near word of largest count, where
    that is at least ``factor`` times its own, and the word its forms lead to."""
    words = stored(words.select("word", "n"))
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.max("n").alias("form_n"),
        F.min_by("near", F.struct(-F.col("n"), "near")).alias("form"),
    )
    best = stored(best)
    all_words = words.join(best, "word", "left")
    is_form = F.col("form_n") >= factor * F.col("n")
    formed = stored(
        all_words.select(
            "word",
            F.when(is_form, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
