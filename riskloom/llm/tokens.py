"""Token counts by rank-synchronous merging over arrays.

The pre-tokens of a batch lie end to end in one symbol array. Each round looks up the rank
of every neighbouring pair, takes the lowest rank within each pre-token and merges all its
occurrences there at once; pre-tokens without a known pair leave the array. What is left of
a pre-token are its tokens. Counts of words are remembered during a task, so an
array holds only words not seen lately.

Edge cases: null and empty texts count 0 tokens; strings of added tokens inside a text
count as one token each, as the library does by default; texts of any length are counted
whole; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, small_batches, text_rows, tidy

CACHED_WORDS = 500_000
LONGEST_CACHED = 40
NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it
    prints, else the next free one from 256 on."""
    prints = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if prints[b] else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of one word-end BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"a normaliser other than NFC, white space and lower case: {kinds}")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pre_tokens = regex.compile(split, regex.V0).findall
        self.white = regex.compile(r"\s+").split
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.added = re.compile("|".join(sorted(added, key=len, reverse=True))) if added else None
        self.base = len(vocab)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.known: dict[str, int] = {}

    def merge_counts(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each (non-empty) pre-token."""
        raw = [t.encode("utf-8") for t in pre_tokens]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = np.zeros(len(raw), np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(raw)), lengths)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(owner)])
            rank = self._ranks(symbols, owner)
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NO_RANK
            counts[owner[first[done]]] = sizes[done]
            hit = (rank == np.repeat(lowest, sizes)) & (rank != NO_RANK)
            at = np.flatnonzero(hit)
            if len(at) == 0:
                break
            # overlapping occurrences (x x x): every second one of a run, from the left
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            at = at[(at - at[np.repeat(run, np.diff(np.r_[run, len(at)]))]) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.repeat(~done, sizes)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbols), NO_RANK, np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        key = symbols[inside] * self.base + symbols[inside + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[place] == key
        rank[inside[found]] = self.ranks[place[found]]
        return rank

    def _learn(self, words: list[str]) -> dict[str, int]:
        """Counts of words that are not remembered."""
        split = [self.pre_tokens(_lower(unicodedata.normalize("NFC", w))) for w in words]
        distinct = {t: None for tokens in split for t in tokens}
        sizes = dict(zip(distinct, self.merge_counts(list(distinct)).tolist(), strict=True)) if distinct else {}
        return {w: sum(map(sizes.__getitem__, tokens)) for w, tokens in zip(words, split, strict=True)}

    def _words(self, text: str) -> tuple[list[str], int]:
        """Words between white space, and the number of added tokens, which also end words."""
        specials = 0
        if self.added is not None and self.added.search(text):
            text, specials = self.added.subn(" ", text)
        # str.split() also splits at four separators that are no white space in Unicode
        rare = any(c in text for c in "\x1c\x1d\x1e\x1f")
        return ([w for w in self.white(text) if w] if rare else text.split()), specials

    def counts(self, texts: list[str]) -> list[int]:
        split = [self._words(t) for t in texts]
        new = {w: None for words, _ in split for w in words if w not in self.known}
        learned = self._learn(list(new)) if new else {}
        if len(self.known) + len(learned) > CACHED_WORDS:
            learned = {**learned, **{w: self.known[w] for words, _ in split for w in words if w in self.known}}
            self.known = {}
        for word, n in learned.items():
            if len(word) <= LONGEST_CACHED and len(self.known) < CACHED_WORDS:
                self.known[word] = n
        known = self.known
        return [sum(known[w] if w in known else learned[w] for w in words) + added for words, added in split]


# fixed values: capitals newer than the Unicode tables of this Python
NEW_CAPITALS = {0xA7CB: 0x0264, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B} | {0x10D50 + k: 0x10D70 + k for k in range(22)}


def _lower(text: str) -> str:
    """Lower case character by character: a final capital sigma has no special form."""
    if not text.isascii():
        text = text.replace("Σ", "σ").translate(NEW_CAPITALS)
    return text.lower()


_counters: dict[str, MergeCounter] = {}


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each text under the vocabulary file."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counters:
            _counters[vocabulary] = MergeCounter(vocabulary)
        counter = _counters[vocabulary]
        for batch in slices(batches):
            counts = counter.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )
        counter.known = {}  # an idle Python worker holds little

    small_batches(docs.sparkSession)
    sized = text_rows(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = sized.mapInArrow(tidy(count), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
