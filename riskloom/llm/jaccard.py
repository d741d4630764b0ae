"""Groups of texts linked by the Jaccard similarity of their word shingles, by set-relation skipping.

1. Equal sets are one: a set is known by two 64-bit sums over its shingles, and the
   smallest document stands for it.
2. Every shingle's number of documents is counted, in arrays (see ``packed``). Shingles of
   one document alone cannot be shared: they come first in the global order, then the
   rarer ones. A set of n shingles needs its first n - ceil(t n) + 1 in an index; where
   these are all its own, it has no partner and leaves.
3. Index lists hold (set, size, position). In each list the set with the least of its own
   stands as the leader; every set is compared with its leaders, and links give a first
   partition into components.
4. Lists that lie in one component are skipped. Other lists fall into blocks by
   component, size and position; pairs of blocks that agree in component, or whose sizes or
   positions bar an overlap large enough, are skipped whole, and only the pairs of the
   blocks left are looked at.
5. Two sets with the same leader share at most min(their overlaps with it) + min(what
   each has beside it) of their shared shingles: their answers follow from the leader's,
   and only pairs that this leaves open are compared. Links between components complete
   the result. A group of thousands of near copies costs a comparison each.

Words are runs other than ASCII white space, A-Z in lower case. Edge cases: a text of fewer
words than a shingle is one shingle; null and empty texts have none and link with nothing
(each is its own component); rows of one id are taken as texts of one document, each with
its own row in the result and the same component as its set; texts are read whole; a null
id is left out; an empty table gives an empty result; other columns are ignored.

``column_components`` gives the same result by DataFrame functions only: shingles are rows
there, counted and joined by Spark. ``jaccard_components`` exchanges them as packed arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, stored, text_rows, tidy
from riskloom.llm.graph import components
from riskloom.llm.packed import (
    BASE,
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

SHINGLE = 5
PERCENT = 80  # least similarity
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENT = "chunk long, bucket int, a binary, b binary"
KEYS = "chunk long, doc_id long, n_shingles long, key_a long, key_b long"
SETS = "set_id long, n long, own long, prefix array<long>, shared binary"


def needed(n_a: Column, n_b: Column, percent: int) -> Column:
    """Least overlap of two sets of these sizes that makes them similar."""
    return F.ceil((n_a + n_b) * percent / (100 + percent) - 1e-9)


def chunk_sets(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document's place, shingle) of all distinct shingles, ascending."""
    owners, values = [], []
    for owner, hashes in chunk.words(lower=True):
        at, value = windows(owner, hashes, size)
        owners.append(owner[at])
        values.append(value)
        places, first, count = np.unique(owner, return_index=True, return_counts=True)
        few = count < size
        owners.append(places[few])
        values.append(np.array([_short_text(hashes[f : f + c]) for f, c in zip(first[few], count[few], strict=True)], np.uint64))
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])] if len(owner) else np.empty(0, bool)
    return owner[new], value[new]


def _short_text(hashes: np.ndarray) -> np.uint64:
    """One shingle of all the words of a short text."""
    total = np.full(1, len(hashes), np.uint64)
    for h in hashes:
        total = mix(total * BASE + h)
    return total[0]


def _bounds(owner: np.ndarray, documents: int) -> np.ndarray:
    return np.searchsorted(owner, np.arange(documents + 1))


def _table(found: list[tuple[int, int, bytes, bytes]]) -> pa.Table:
    chunk, number, a, b = zip(*found, strict=True) if found else ((), (), (), ())
    return pa.table(
        {
            "chunk": pa.array(chunk, pa.int64()),
            "bucket": pa.array(number, pa.int32()),
            "a": pa.array(a, pa.binary()),
            "b": pa.array(b, pa.binary()),
        }
    )


def set_keys(packed: DataFrame, size: int) -> DataFrame:
    """``chunk, doc_id, n_shingles, key_a, key_b`` of every text."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.of(row)
                owner, value = chunk_sets(chunk, size)
                edges = _bounds(owner, len(chunk.ids))
                sums = [np.r_[np.uint64(0), np.cumsum(v)] for v in (value, mix(value ^ BASE))]
                a, b = ((s[edges[1:]] - s[edges[:-1]]).view(np.int64) for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(a), chunk.number)),
                        pa.array(chunk.ids),
                        pa.array(np.diff(edges)),
                        pa.array(a),
                        pa.array(b),
                    ],
                    names=["chunk", "doc_id", "n_shingles", "key_a", "key_b"],
                )

    return packed.mapInArrow(tidy(keys), KEYS)


def shared_shingles(packed: DataFrame, size: int, buckets: int) -> DataFrame:
    """For each chunk and bucket the shingles that several documents have, and how many, in quarter powers of two."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                value, count = np.unique(chunk_sets(Chunk.of(row), size)[1], return_counts=True)
                found = []
                for number, places in by_bucket(value, buckets):
                    code, order = np.unique(short(value[places]), return_inverse=True)
                    total = np.bincount(order, weights=count[places]).astype(np.uint32)
                    found.append((row["chunk"], number, pack_sorted(code), pack(total)))
                yield from _table(found).to_batches()

    def count(table: pa.Table) -> pa.Table:
        give_back()
        rows = table.to_pylist()
        codes = [unpack_sorted(r["a"], np.uint32) for r in rows]
        value, place = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([unpack(r["b"], np.uint32) for r in rows]))
        level = np.minimum(4 * np.log2(total), 255).astype(np.uint8)
        found, at = [], 0
        for r, code in zip(rows, codes, strict=True):
            own = level[place[at : at + len(code)]]
            at += len(code)
            if own.any():
                found.append((r["chunk"], r["bucket"], pack_sorted(code[own > 0]), pack(own[own > 0])))
        return _table(found)

    return packed.mapInArrow(tidy(send), SENT).groupBy("bucket").applyInArrow(count, SENT)


def indexed_sets(packed: DataFrame, shared: DataFrame, copies: DataFrame, size: int, buckets: int, percent: int) -> DataFrame:
    """``set_id, n, own, prefix, shared`` of the sets that may have partners: how many shingles
    are theirs alone, the index entries in order, and all others' shingles, ascending.
    ``copies`` names per chunk the documents that another stands for."""

    def build(texts: pa.Table, found: pa.Table) -> pa.Table:
        give_back()
        out: dict[str, list] = {k: [] for k in ("set_id", "n", "own", "prefix", "shared")}
        if texts.num_rows and found.num_rows:
            chunk = Chunk.of(texts.to_pylist()[0])
            rows = found.to_pylist()
            skipped = np.concatenate([np.empty(0, np.int64), *(unpack(r["a"], np.int64) for r in rows if r["bucket"] < 0)])
            owner, value = chunk_sets(chunk, size)
            level = np.zeros(len(value), np.uint8)
            lists = {r["bucket"]: r for r in rows}
            for number, places in by_bucket(value, buckets):
                if number in lists:
                    code = unpack_sorted(lists[number]["a"], np.uint32)
                    mine = short(value[places])
                    at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
                    level[places] = np.where(code[at] == mine, unpack(lists[number]["b"], np.uint8)[at], 0)
            edges = _bounds(owner, len(chunk.ids))
            skip = np.isin(np.arange(len(chunk.ids)), skipped)
            for place, doc_id in enumerate(chunk.ids.tolist()):
                low, high = edges[place], edges[place + 1]
                n = int(high - low)
                common = value[low:high][level[low:high] > 0]
                own = n - len(common)
                entries = n - -(-n * percent // 100) + 1 - own
                if n and not skip[place] and entries > 0:
                    order = np.lexsort((common, level[low:high][level[low:high] > 0]))[:entries]
                    out["set_id"].append(doc_id)
                    out["n"].append(n)
                    out["own"].append(own)
                    out["prefix"].append(common[order].view(np.int64))
                    out["shared"].append(common.tobytes())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})

    return packed.groupBy("chunk").cogroup(shared.union(copies).groupBy("chunk")).applyInArrow(build, SETS)


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, overlap, linked`` of the pairs ``a, b``; ``shared`` is a binary or an array."""
    left = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("of_a"))
    right = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("of_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("of_a"), batch.column("of_b"), strict=True)
            found = [
                len(np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True))
                for x, y in sides
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(found, pa.int64())],
                names=["a", "b", "n_a", "n_b", "overlap"],
            )

    if dict(sets.dtypes)["shared"] == "binary":
        counted = joined.mapInArrow(tidy(overlap), "a long, b long, n_a long, n_b long, overlap long")
    else:
        counted = joined.withColumn("overlap", F.size(F.array_intersect("of_a", "of_b")).cast("long"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return counted.select("a", "b", "overlap", (F.col("overlap") * 100 >= union * percent).alias("linked"))


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes, shared shingles and positions of two index entries allow the overlap needed."""
    need = needed(F.col(f"{a}.n"), F.col(f"{b}.n"), percent)
    return (F.least(f"{a}.most", f"{b}.most") >= need) & (
        F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place")) >= need
    )


def leader_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Each set with the leader of every list it is in."""
    lists = entries.groupBy("token").agg(
        F.count("*").alias("sets"), F.min(F.struct(F.col("own") / F.col("n"), "set_id", "n", "most", "place")).alias("l")
    )
    leaders = lists.where("sets > 1").select("token", F.col("l.set_id").alias("set_id"), "l.n", "l.most", "l.place")
    both = entries.alias("x").join(leaders.alias("y"), F.col("x.token") == F.col("y.token"))
    kept = both.where((F.col("x.set_id") != F.col("y.set_id")) & _possible("x", "y", percent))
    return kept.select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b")).distinct()


def open_pairs(entries: DataFrame, group: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different components that the lists and the leaders' answers leave open.

    ``group`` has ``set_id, component``, ``known`` the compared pairs ``a, b, overlap``."""
    best = known.groupBy(F.col("a").alias("set_id")).agg(F.max(F.struct("overlap", "b")).alias("o"))
    told = group.join(best, "set_id", "left").select(
        "set_id", "component", F.col("o.b").alias("leader"), F.col("o.overlap").alias("with_leader")
    )
    # a leader is its own leader: its answers are those of its whole set
    placed = entries.join(told, "set_id", "left").withColumns(
        {
            "component": F.coalesce("component", "set_id"),
            "leader": F.coalesce("leader", "set_id"),
            "with_leader": F.coalesce("with_leader", "most"),
        }
    )
    mixed = placed.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    left = placed.join(mixed.select("token"), "token")
    blocks = left.withColumns(
        {
            "size_band": F.floor(F.log("n") / F.log(F.lit(1.1))),
            "place_band": F.floor(F.col("place") * 20 / F.col("n")),
        }
    )
    blocks = stored(blocks)
    keys = ["token", "component", "size_band", "place_band"]
    heads = blocks.groupBy(*keys).agg(
        F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.max("most").alias("most"),
        F.max(F.col("n") - F.col("place")).alias("rest"),
    )
    x, y = heads.alias("x"), heads.alias("y")
    least = needed(F.col("x.n_low"), F.col("y.n_low"), percent)
    near = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") < F.col("y.component"))
        & (F.col("x.n_high") * 100 >= F.col("y.n_low") * percent)
        & (F.col("y.n_high") * 100 >= F.col("x.n_low") * percent)
        & (F.least("x.most", "y.most", "x.rest", "y.rest") >= least)
    )
    met = x.join(y, near).select(
        *(F.col(f"x.{k}").alias(k) for k in keys), *(F.col(f"y.{k}").alias(f"{k}_b") for k in keys[1:])
    )
    columns = ["set_id", "n", "most", "place", "leader", "with_leader"]
    first = met.join(blocks.select(*keys, F.struct(*columns).alias("s")), keys)
    second = blocks.select(
        "token", *(F.col(k).alias(f"{k}_b") for k in keys[1:]), F.struct(*columns).alias("t")
    )
    pairs = first.join(second, ["token", *(f"{k}_b" for k in keys[1:])])
    by_leader = F.least("s.with_leader", "t.with_leader") + F.least(
        F.col("s.most") - F.col("s.with_leader"), F.col("t.most") - F.col("t.with_leader")
    )
    told_off = (F.col("s.leader") == F.col("t.leader")) & (by_leader < needed(F.col("s.n"), F.col("t.n"), percent))
    open_ = pairs.where(_possible("s", "t", percent) & ~told_off)
    return open_.select(F.least("s.set_id", "t.set_id").alias("a"), F.greatest("s.set_id", "t.set_id").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row with an id; the component is the smallest id in it."""
    packed = chunks(docs, id_col, text_col)
    buckets = bucket_count(packed)
    keys = stored(set_keys(packed, size))
    key = ["n_shingles", "key_a", "key_b"]
    # stored, so that the join below can split the rows of a set with very many copies
    classes = stored(keys.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("set_id")))
    known = stored(keys.join(classes, key, "left").withColumn("set_id", F.coalesce("set_id", "doc_id")))
    copies = _copies(packed, known)

    sets = stored(indexed_sets(packed, shared_shingles(packed, size, buckets), copies, size, buckets, percent))
    return _linked(known, sets, percent)


def _linked(known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The result for the rows of ``known`` (``doc_id, n_shingles, set_id``) from the ``sets`` that may have partners."""
    most = (F.col("n") - F.col("own")).alias("most")
    entries = sets.select("set_id", "n", "own", most, F.posexplode("prefix").alias("rank", "token")).withColumn(
        "place", F.col("own") + F.col("rank")
    )
    first = stored(compare(leader_pairs(entries, percent), sets, percent))
    group = components(first.where("linked")).select(F.col("node").alias("set_id"), "component")
    second = compare(open_pairs(entries, group, first, percent), sets, percent)
    links = first.where("linked").select("a", "b").union(second.where("linked").select("a", "b"))
    found = components(links).withColumnRenamed("node", "set_id")
    return known.join(found, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "set_id").alias("component_id")
    )


def _copies(packed: DataFrame, known: DataFrame) -> DataFrame:
    """Per chunk, as a list under bucket -1, the places of documents that another stands for."""

    def places(texts: pa.Table, rows: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        ids = unpack(row["ids"], np.int64)
        copied = np.isin(ids, np.array(rows.column("doc_id").to_pylist(), np.int64))
        return _table([(row["chunk"], -1, pack(np.flatnonzero(copied)), b"")])

    others = known.where("set_id <> doc_id").select("chunk", "doc_id")
    return packed.select("chunk", "ids").groupBy("chunk").cogroup(others.groupBy("chunk")).applyInArrow(places, SENT)


def shingle_set(text: Column, size: int) -> Column:
    """Hashes of the distinct shingles of a text, ascending."""
    words = F.array_remove(F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+"), "")

    def rolling(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - size)
        runs = F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size))))
        return F.when(F.size(h) >= size, runs).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.slice(h, 1, 0))

    # within an array of one, so that the words are hashed once and not for each shingle
    runs = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), rolling)
    return F.sort_array(F.array_distinct(F.get(runs, F.lit(0))))


def column_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``jaccard_components`` by DataFrame functions only, for few or short texts."""
    texts = text_rows(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    rows = stored(texts.select("doc_id", shingle_set(F.col("text"), size).alias("shingles")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    hashes = (F.xxhash64("shingles").alias("key_a"), F.xxhash64("shingles", F.lit(1)).alias("key_b"))
    keys = stored(rows.select("row", "doc_id", F.size("shingles").cast("long").alias("n_shingles"), *hashes, "shingles"))
    key = ["n_shingles", "key_a", "key_b"]
    first = F.min(F.struct("doc_id", "row"))
    classes = stored(
        keys.where("n_shingles > 0").groupBy(*key).agg(first.alias("first")).select(*key, "first.*")
        .withColumnsRenamed({"doc_id": "set_id", "row": "set_row"})
    )
    known = keys.select("doc_id", *key).join(classes.select(*key, "set_id"), key, "left")
    known = stored(known.select("doc_id", "n_shingles", F.coalesce("set_id", "doc_id").alias("set_id")))

    owners = classes.select("set_row", "set_id", F.col("n_shingles").alias("n"))
    held = stored(keys.select("row", "shingles").join(owners, F.col("row") == F.col("set_row")).drop("row"))
    held = held.select("set_row", "set_id", "n", F.explode("shingles").alias("token"))
    counts = stored(held.groupBy("token").agg(F.count("*").alias("texts")).where("texts > 1"))
    shared = held.join(counts, "token").groupBy("set_row", "set_id", "n")
    shared = shared.agg(F.sort_array(F.collect_list(F.struct("texts", "token"))).alias("tokens"))
    own = F.col("n") - F.size("tokens")
    entries = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("own")).cast("int")
    sets = shared.withColumn("own", own).withColumn("entries", entries).where("entries > 0")
    tokens = F.col("tokens.token")
    sets = stored(sets.select("set_id", "n", "own", F.slice(tokens, 1, F.col("entries")).alias("prefix"), tokens.alias("shared")))
    return _linked(known, sets, percent)
