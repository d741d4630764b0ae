"""Removal of word runs that repeat an earlier document, by fixed-block anchors.

A run of ``window`` words (13) that two documents share covers, in either, one whole block
of ``(window + 1) // 2`` words (7) among the blocks that do not overlap and start at word 0
of a document. So these blocks are the index, and every rolling block of every document
probes it. Only where a probe hits are windows looked at: hits grow to the exact windows
around them, each distinct window of a chunk is sent once, with the smallest document that
starts it there and its place, and the place comes back if a smaller document elsewhere
starts it. Neighbouring windows that come back join to maximal repeats, whose words go.
Texts are hashed for the probes and for the windows; the words are cut out by place.

Edge cases: null and empty texts have no words; fewer words than a window, nothing goes;
a document's repeats within itself stay; equal texts in full keep only the copy of the
smallest id; rows of one id count as one document; texts are read whole, rows with a null
id are left out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import give_back, tidy
from riskloom.llm.packed import (
    Chunk,
    bucket_count,
    by_bucket,
    chunks,
    mix,
    pack,
    pack_sorted,
    short,
    unpack,
    unpack_sorted,
    windows,
)

WINDOW = 13
SENT = "chunk long, bucket int, a binary, b binary"
AROUND = "chunk long, bucket int, a binary, b binary, c binary"
ANSWER = "chunk long, a binary, b binary, c binary"
TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _rows(found: list[tuple], shape: str = SENT) -> pa.Table:
    columns = [c.split() for c in shape.split(", ")]
    values = zip(*found, strict=True) if found else [()] * len(columns)
    return pa.table({name: pa.array(v, TYPES[kind]) for (name, kind), v in zip(columns, values, strict=True)})


def _block_probes(chunk: Chunk, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each rolling block hash of the chunk once; whether it is an aligned block somewhere in
    it, and whether several documents of the chunk have it."""
    found = []
    for owner, hashes in chunk.words():
        at, value = windows(owner, hashes, block)
        if len(at):
            begins = np.searchsorted(owner, owner[at])  # first word of the document
            found.append((value, (at - begins) % block == 0, owner[at]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, bool)
    value, aligned, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(value)
    value, aligned, owner = value[order], aligned[order], chunk.ids[owner[order]]
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    return value[first], np.logical_or.reduceat(aligned, first), several


def _by_code(code: np.ndarray, aligned: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, and the flags (1 aligned, 2 several) of all blocks that share each."""
    kept, place = np.unique(code, return_inverse=True)
    flags = np.zeros(len(kept), np.uint8)
    np.bitwise_or.at(flags, place, aligned + 2 * several.astype(np.uint8))
    return kept, flags


def _hit_windows(
    chunk: Chunk, hits: dict[int, np.ndarray], buckets: int, size: int, block: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document's id, place of the first word in the chunk, window hash) where a block was hit, in order."""
    blocks, wide, words = [], [], 0
    for owner, hashes in chunk.words():
        at, value = windows(owner, hashes, block)
        blocks.append((at + words, value))
        start, window = windows(owner, hashes, size)
        wide.append((chunk.ids[owner[start]], start + words, window))
        words += len(hashes)
    at, value = (np.concatenate(x) for x in zip(*blocks, strict=True))
    own, start, window = (np.concatenate(x) for x in zip(*wide, strict=True))
    shift = np.uint64(32)
    wanted = np.concatenate([(np.uint64(b) << shift) | hits[b] for b in sorted(hits)])
    code = (value % np.uint64(buckets) << shift) | short(value)
    order = np.argsort(code)
    code = code[order]
    found = wanted[np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)] == code
    hit = np.zeros(words + 1, bool)
    hit[at[order[found]]] = True
    covered = np.r_[0, np.cumsum(hit)]
    inside = covered[np.minimum(start + size - block + 1, len(hit))] > covered[start]
    return own[inside], start[inside], window[inside]


def _least(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of value, where each value begins among them, and its smallest id for each of them."""
    order = np.argsort(values)
    ranked = values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(values) else order
    least = np.minimum.reduceat(ids[order], first) if len(values) else ids
    return order, first, np.repeat(least, np.diff(np.r_[first, len(values)]))


def _senders(
    own: np.ndarray, start: np.ndarray, window: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk's windows: whether a smaller document of the chunk starts it, whether it is the
    one to be sent (the first of the smallest document), and which others go as one sent goes."""
    order, first, least = _least(window, own)
    earlier = np.zeros(len(own), bool)
    earlier[order] = own[order] > least
    end = np.iinfo(np.int64).max
    sent = np.minimum.reduceat(np.where(earlier, end, start)[order], first) if len(own) else start
    leader = np.empty(len(own), np.int64)
    leader[order] = np.repeat(sent, np.diff(np.r_[first, len(own)]))
    again = ~earlier & (start != leader)
    return earlier, ~earlier & ~again, start[again], leader[again]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if wanted, ``kept``: the words left, joined by spaces."""
    block = (window + 1) // 2
    packed = chunks(docs, id_col, text_col)
    buckets = bucket_count(packed)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                value, aligned, several = _block_probes(Chunk.of(row), block)
                found = []
                for number, places in by_bucket(value, buckets):
                    kept, flags = _by_code(short(value[places]), aligned[places], several[places])
                    found.append((row["chunk"], number, pack_sorted(kept), pack(flags)))
                yield from _rows(found).to_batches()

    def match(table: pa.Table) -> pa.Table:
        """Blocks that some document has aligned and at least two documents have."""
        give_back()
        rows = table.to_pylist()
        values = [unpack_sorted(r["a"], np.uint32) for r in rows]
        flags = np.concatenate([unpack(r["b"], np.uint8) for r in rows])
        value, place, seen = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        aligned, several = np.zeros(len(value), bool), seen > 1
        aligned[place[flags & 1 > 0]] = True
        several[place[flags & 2 > 0]] = True
        shared, found, at = (aligned & several)[place], [], 0
        for r, v in zip(rows, values, strict=True):
            kept = v[shared[at : at + len(v)]]
            at += len(v)
            if len(kept):
                found.append((r["chunk"], r["bucket"], pack_sorted(kept), b""))
        return _rows(found)

    def extend(texts: pa.Table, found: pa.Table) -> pa.Table:
        """Each distinct window around a hit, with the chunk's smallest document that starts it and
        the place; in one more row the places that this chunk decides."""
        give_back()
        if not texts.num_rows or not found.num_rows:
            return _rows([], AROUND)
        chunk = Chunk.of(texts.to_pylist()[0])
        hits = {r["bucket"]: unpack_sorted(r["a"], np.uint32) for r in found.to_pylist()}
        own, start, value = _hit_windows(chunk, hits, buckets, window, block)
        earlier, sent, again, leader = _senders(own, start, value)
        decided = (pack_sorted(start[earlier]), pack_sorted(again), pack(leader))
        # passes through a bucket of its own
        number = int(mix(np.array([chunk.number], np.uint64))[0] % np.uint64(buckets))
        own, start, value = own[sent], start[sent], value[sent]
        rows = [(chunk.number, n, pack(value[p]), pack_sorted(start[p]), pack(own[p])) for n, p in by_bucket(value, buckets)]
        return _rows([*rows, (chunk.number, -1 - number, *decided)], AROUND)

    def resolve(table: pa.Table) -> pa.Table:
        """For each chunk the places of its windows that a smaller document of another chunk starts."""
        give_back()
        rows = table.to_pylist()
        answers = [(r["chunk"], r["a"], r["b"], r["c"]) for r in rows if r["bucket"] < 0]
        rows = [r for r in rows if r["bucket"] >= 0]
        if rows:
            ids = [unpack(r["c"], np.int64) for r in rows]
            own = np.concatenate(ids)
            order, _, least = _least(np.concatenate([unpack(r["a"], np.uint64) for r in rows]), own)
            smaller = np.empty(len(own), bool)
            smaller[order] = least < own[order]
            at = 0
            for r, held in zip(rows, ids, strict=True):
                mine = smaller[at : at + len(held)]
                at += len(held)
                if mine.any():
                    answers.append((r["chunk"], pack_sorted(unpack_sorted(r["b"], np.int64)[mine]), None, None))
        return _rows(answers, ANSWER)

    def cut(texts: pa.Table, found: pa.Table) -> pa.Table:
        give_back()
        chunk = Chunk.of(texts.to_pylist()[0])
        rows = found.to_pylist()
        starts = [unpack_sorted(r["a"], np.int64) for r in rows]
        elsewhere = np.concatenate([np.empty(0, np.int64), *(p for r, p in zip(rows, starts, strict=True) if r["b"] is None)])
        for r in rows:
            if r["b"] is not None:
                starts.append(unpack_sorted(r["b"], np.int64)[np.isin(unpack(r["c"], np.int64), elsewhere)])
        start = np.sort(np.concatenate([np.empty(0, np.int64), *starts]))
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        first = low = 0
        for place, doc_id in enumerate(chunk.ids.tolist()):
            words = chunk.data[chunk.offsets[place] : chunk.offsets[place + 1]].split()
            count = len(words)
            out["doc_id"].append(doc_id)
            out["n_words"].append(count)
            high = low + int(np.searchsorted(start[low:], first + count))
            if low < high:
                change = np.zeros(count + 1, np.int64)
                change[start[low:high] - first] = 1
                change[start[low:high] - first + window] -= 1
                words = list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))
            out["n_removed"].append(count - len(words))
            first, low = first + count, high
            text = b" ".join(words)
            out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            if keep_text:
                out["kept"].append(text.decode("utf-8"))
        if not keep_text:
            del out["kept"]
        return pa.table({k: pa.array(v, KINDS[k]) for k, v in out.items()})

    probes = packed.mapInArrow(tidy(probe), SENT)
    hits = probes.groupBy("bucket").applyInArrow(match, SENT)
    by_chunk = packed.groupBy("chunk")
    around = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, AROUND)
    answers = around.groupBy("bucket").applyInArrow(resolve, ANSWER)
    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if keep_text else "")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(cut, shape)


KINDS = {
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "n_removed": pa.int64(),
    "kept_sha256": pa.string(),
    "kept": pa.string(),
}
