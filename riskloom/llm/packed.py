"""Texts packed in chunks, and exchanges of their hashes that move arrays instead of rows.

``chunks`` writes the texts once to the shared folder, compressed, some megabytes to a
row; their number follows the size of the input. Operators on word windows hash a chunk at
a time and send every bucket one array per chunk with each hash once, however often it
occurs in the chunk. What a bucket finds goes back to the chunks the same way. A window
that a third of all documents holds is one number per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, small_batches, stored, text_rows, tidy

CHUNK_BYTES = 4 << 20
HASHES_PER_BUCKET = 1_500_000
SLICE_BYTES = 1 << 19
MIX_A, MIX_B, BASE = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_codec = pa.Codec("zstd", compression_level=3)


def compressed(data: bytes) -> bytes:
    return _codec.compress(data, asbytes=True) if data else b""


def expanded(data: bytes, size: int) -> bytes:
    return _codec.decompress(data, size, asbytes=True) if size else b""


def pack(array: np.ndarray) -> bytes:
    """An integer array as bytes: byte planes, compressed."""
    array = np.ascontiguousarray(array)
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T.tobytes()
    head = np.array([len(array), array.itemsize], np.int64).tobytes()
    return head + compressed(planes)


def unpack(data: bytes, kind: type) -> np.ndarray:
    count, width = np.frombuffer(data[:16], np.int64).tolist()
    planes = np.frombuffer(expanded(data[16:], count * width), np.uint8)
    return planes.reshape(width, count).T.copy().view(kind).reshape(-1)


def pack_sorted(array: np.ndarray) -> bytes:
    """An ascending array, as its differences."""
    return pack(np.diff(array, prepend=array.dtype.type(0)))


def unpack_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``chunk, n_words, ids, sizes, texts``: every row's id and text (null: empty), packed."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            joined = b"".join(texts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number]),
                    pa.array([sum(len(t.split()) for t in texts)]),
                    pa.array([pack(np.array(ids, np.int64))], pa.binary()),
                    pa.array([pack(np.array([len(t) for t in texts], np.int64))], pa.binary()),
                    pa.array([compressed(joined)], pa.binary()),
                ],
                names=["chunk", "n_words", "ids", "sizes", "texts"],
            )

        for batch in slices(batches, SLICE_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = text.encode("utf-8")
                if texts and held + len(data) > CHUNK_BYTES:
                    yield row()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(data)
                held += len(data) + 64
        if texts:
            yield row()

    small_batches(docs.sparkSession)
    rows = text_rows(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    return stored(rows.mapInArrow(tidy(fill), "chunk long, n_words long, ids binary, sizes binary, texts binary"))


@dataclass
class Chunk:
    number: int
    ids: np.ndarray
    offsets: np.ndarray
    data: bytes

    @staticmethod
    def of(row: dict) -> Chunk:
        sizes = unpack(row["sizes"], np.int64)
        data = expanded(row["texts"], int(sizes.sum()))
        return Chunk(row["chunk"], unpack(row["ids"], np.int64), np.r_[0, np.cumsum(sizes)], data)

    def words(self, lower: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document's place in the chunk, hash) of all words, some documents at a time, in order."""
        first = 0
        while first < len(self.ids):
            end = int(np.searchsorted(self.offsets, self.offsets[first] + SLICE_BYTES, side="right")) - 1
            end = max(end, first + 1)
            data = self.data[self.offsets[first] : self.offsets[end]]
            owner, hashes = hash_words(data.translate(TO_LOWER) if lower else data, self.offsets[first : end + 1])
            yield owner + first, hashes
            first = end


# which bytes are part of a word: all but ASCII white space
NOT_WHITE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def hash_words(data: bytes, offsets: np.ndarray, inner: np.ndarray = NOT_WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of each word, a run of ``inner`` bytes; words end where a document ends."""
    code = np.frombuffer(data, np.uint8)
    solid = inner[code]
    if not solid.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[:-1] - offsets[0]
    edges = edges[edges < len(code)]
    begins[edges] |= solid[edges]
    starts = np.flatnonzero(begins)
    inside = np.arange(len(code)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(code)]))
    lengths = np.add.reduceat(solid.astype(np.int64), starts)
    longest = int(inside[solid].max()) + 1
    powers = np.cumprod(np.full(longest, BASE, np.uint64))
    values = np.where(solid, code.astype(np.uint64) + np.uint64(1), np.uint64(0))
    values *= powers[np.minimum(inside, longest - 1)]
    hashes = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
    owner = np.searchsorted(offsets, starts + offsets[0], side="right") - 1
    return owner, hashes


def windows(owner: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of each run of ``size`` words of one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * BASE + hashes[k : k + n]
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return at, mix(total[at])


def bucket_count(packed: DataFrame) -> int:
    """Buckets so that each gets about ``HASHES_PER_BUCKET`` hashes."""
    words = packed.agg(F.sum("n_words")).first()[0] or 0
    return max(8, -(-words // HASHES_PER_BUCKET))


def by_bucket(hashes: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in ``hashes``) for the buckets that have any; ``hashes`` ascending or not."""
    # few bits sort without comparisons
    which = (hashes % np.uint64(count)).astype(np.uint16 if count <= 1 << 16 else np.int64)
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(count + 1))
    for b in range(count):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def short(hashes: np.ndarray) -> np.ndarray:
    """The 32 bits that stand for a hash within its bucket."""
    return (hashes >> np.uint64(32)).astype(np.uint32)
