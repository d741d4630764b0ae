"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

``build_index`` cuts the documents into shards of some megabytes of text and writes, for every
term of a shard, its posting list in blocks. A block keeps its first and last document, its
(occurrences, length) pairs that no other posting of the block beats - so its largest score is
exact whatever the corpus statistics turn out to be - and its postings, compressed.

``search`` joins the lists with the terms of the queries, so a list arrives in its shard's task
together with the queries that ask for it. A task goes through its shard a range of documents
at a time. A query's lists are ordered by their largest contribution: those that together
cannot reach the score of its k-th best document so far are non-essential. Candidates come
from the essential lists alone; for the others a block's maximum rejects a candidate before
the block is decompressed. The heaps of all shards are merged by one ranked aggregate.

Queries are taken in groups of ``QUERIES``, each against all shards; nothing passes through
the driver but the corpus' two sums.

Edge cases: null and empty texts have no terms and match nothing; texts of any length are
taken whole (a shard holds one document at least); documents with a null id count, and come
last among equal scores; repeated documents are documents of their own; repeated queries of
equal id and text count once, queries of equal id and other text are answered each; empty
tables give an empty result; other columns are ignored. Terms are known by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, slices, small_batches, stored, text_rows, tidy
from riskloom.llm.packed import SLICE_BYTES, TO_LOWER, hash_words

SHARD_BYTES = 12 << 20
BLOCK = 128
RANGE = 4_096  # documents of a shard that are scored at once
QUERIES = 512
NO_ID = np.iinfo(np.int64).max  # stands for a null id, so that it comes last
# which bytes are part of a term: digits, letters, and all beyond ASCII
TERM_BYTES = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in range(256)])

_codec = pa.Codec("lz4_raw")


# --- the index -----------------------------------------------------------------------

DOCUMENTS = "shard long, ids array<long>, lengths array<int>"
BLOCKS = "array<struct<first:int,last:int,n:int,peak_tf:array<int>,peak_length:array<int>,data:binary>>"
LISTS = f"shard long, term long, n int, blocks {BLOCKS}"


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the text, hash) of every term, in order."""
    data = [t.encode("utf-8") for t in texts]
    offsets = np.r_[0, np.cumsum([len(d) for d in data])].astype(np.int64)
    owner, hashes = hash_words(b"".join(data).translate(TO_LOWER), offsets, TERM_BYTES)
    return owner, hashes.view(np.int64)


def _postings(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, document) in order, with the occurrences of each."""
    order = np.lexsort((owner, term))
    owner, term = owner[order], term[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return term[at], owner[at], np.diff(np.r_[at, len(term)])


def _peaks(block: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the postings that none of their block beats (more occurrences in a document no
    longer), and the block of each."""
    order = np.lexsort((length, -tf, block))
    shift = block[order] * (int(length.max()) + 1)  # a later block starts anew
    running = np.minimum.accumulate(length[order] - shift)
    best = np.ones(len(order), bool)
    best[1:] = running[1:] < running[:-1]
    return order[best], block[order][best]


def _list_array(values: np.ndarray, owner: np.ndarray, count: int) -> pa.ListArray:
    ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=count))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _index_shard(shard: int, ids: list[int | None], texts: list[str]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The documents and the lists of one shard; documents are numbered by ascending id."""
    key = np.array([NO_ID if i is None else i for i in ids], np.int64)
    order = np.argsort(key, kind="stable")
    owners, terms, start = [], [], 0
    texts = [texts[k] for k in order]
    while start < len(texts):  # some texts at a time
        end, held = start + 1, len(texts[start])
        while end < len(texts) and held + len(texts[end]) <= SLICE_BYTES:
            held += len(texts[end])
            end += 1
        owner, term = terms_of(texts[start:end])
        owners.append((owner + start).astype(np.int32))
        terms.append(term)
        start = end
    owner, term = np.concatenate(owners), np.concatenate(terms)
    lengths = np.bincount(owner, minlength=len(texts))
    yield "documents", pa.RecordBatch.from_arrays(
        [
            pa.array([shard]),
            pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), pa.array(key[order])),
            pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), pa.array(lengths.astype(np.int32))),
        ],
        names=["shard", "ids", "lengths"],
    )
    if not len(term):
        return
    term, doc, tf = _postings(owner, term)
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    sizes = np.diff(np.r_[starts, len(term)])
    place = np.arange(len(term)) - np.repeat(starts, sizes)
    opens = place % BLOCK == 0
    block = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    end = np.r_[first[1:], len(term)]
    which, of = _peaks(block, tf, lengths[doc])
    both = np.stack([np.diff(doc, prepend=0), tf]).astype(np.int32)
    both[0, first] = 0
    data = [_codec.compress(both[:, a:b].tobytes(), asbytes=True) for a, b in zip(first.tolist(), end.tolist(), strict=True)]
    entries = pa.StructArray.from_arrays(
        [
            pa.array(doc[first].astype(np.int32)),
            pa.array(doc[end - 1].astype(np.int32)),
            pa.array((end - first).astype(np.int32)),
            _list_array(tf[which], of, len(first)),
            _list_array(lengths[doc[which]], of, len(first)),
            pa.array(data, pa.binary()),
        ],
        names=["first", "last", "n", "peak_tf", "peak_length", "data"],
    )
    ends = np.r_[0, np.cumsum(-(-sizes // BLOCK))].astype(np.int32)
    lists = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(starts), shard)),
            pa.array(term[starts]),
            pa.array(sizes.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), entries),
        ],
        names=["shard", "term", "n", "blocks"],
    )
    for at in range(0, len(starts), 4_096):
        yield "lists", lists.slice(at, 4_096)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The stored index: ``shard, ids, lengths`` with one row per shard, and ``shard, term, n,
    blocks`` with one row per term of a shard."""
    spark = docs.sparkSession
    small_batches(spark)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        texts: list[str] = []

        def shard() -> Iterator[pa.RecordBatch]:
            for table, rows in _index_shard((part << 32) + number, ids, texts):
                yield _as_row(table, rows)
            give_back()

        for batch in slices(batches, SLICE_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if texts and held + len(text) > shard_bytes:
                    yield from shard()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(text)
                held += len(text) + 64
        if texts:
            yield from shard()

    shape = f"shard long, ids array<long>, lengths array<int>, term long, n int, blocks {BLOCKS}"
    both = stored(text_rows(docs, id_col, text_col).mapInArrow(tidy(fill), shape))
    documents = both.where(F.col("ids").isNotNull()).select("shard", "ids", "lengths")
    return documents, both.where(F.col("term").isNotNull()).select("shard", "term", "n", "blocks")


_ROW = pa.schema(
    [
        ("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
        ("term", pa.int64()), ("n", pa.int32()),
        ("blocks", pa.list_(pa.struct([
            ("first", pa.int32()), ("last", pa.int32()), ("n", pa.int32()),
            ("peak_tf", pa.list_(pa.int32())), ("peak_length", pa.list_(pa.int32())), ("data", pa.binary()),
        ]))),
    ]
)


def _as_row(table: str, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of either table, with nulls for the other's columns."""
    given = set(rows.schema.names)
    columns = [rows.column(f.name).cast(f.type) if f.name in given else pa.nulls(len(rows), f.type) for f in _ROW]
    return pa.RecordBatch.from_arrays(columns, schema=_ROW)


# --- queries ---------------------------------------------------------------------------


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, query (a hash of id and text), term, repeats`` of every distinct query."""
    rows = items.select(
        F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).distinct()
    rows = rows.withColumn("query", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit("\0"), "text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, term = terms_of(batch.column("text").to_pylist())
            if len(term):
                term, owner, repeats = _postings(owner, term)
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(at), batch.column("query").take(at), pa.array(term), pa.array(repeats)],
                    names=["item_id", "query", "term", "repeats"],
                )

    small_batches(items.sparkSession)
    return rows.mapInArrow(cut, "item_id long, query long, term long, repeats long")


def _weight(documents: int, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.ln(F.lit(float(2 * documents + 2)) / (2 * df + 1))).cast("long")


# --- scoring a shard ---------------------------------------------------------------------


class Corpus:
    """The two corpus sums and what a posting contributes to a score for weight one."""

    def __init__(self, documents: int, total: int):
        self.documents, self.total = documents, total

    def impact(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        tf, length = tf.astype(np.int64), length.astype(np.int64)
        m = 25 + (75 * length * self.documents) // self.total
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class PostingList:
    """A term's list in a shard; blocks are decompressed when they are first asked for."""

    def __init__(self, blocks: pa.StructArray, lengths: np.ndarray, corpus: Corpus):
        self.first, self.last = blocks.field("first").to_numpy(), blocks.field("last").to_numpy()
        self.n, self.data = blocks.field("n").to_numpy(), blocks.field("data")
        self.lengths, self.corpus = lengths, corpus
        tf, size = blocks.field("peak_tf"), blocks.field("peak_length")
        counts = pa.compute.list_value_length(tf).to_numpy()
        peaks = corpus.impact(tf.flatten().to_numpy(), size.flatten().to_numpy())
        self.peak = np.maximum.reduceat(peaks, np.cumsum(counts) - counts)
        self.bound = int(self.peak.max())
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        found = self.opened.get(k)
        if found is None:
            n = int(self.n[k])
            raw = _codec.decompress(self.data[k].as_buffer(), n * 8)
            delta, tf = np.frombuffer(raw, np.int32).reshape(2, n)
            docs = np.cumsum(delta) + self.first[k]
            found = self.opened[k] = docs, self.corpus.impact(tf, self.lengths[docs])
        return found

    def within(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``start`` to before ``end``, and their impacts."""
        low, high = np.searchsorted(self.last, start), np.searchsorted(self.first, end)
        parts = [self.block(k) for k in range(low, high)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, impacts = (np.concatenate(p) for p in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]
        a, b = np.searchsorted(docs, [start, end])
        return docs[a:b], impacts[a:b]


class Heap:
    """The k best documents of a query so far, by score and then by number."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """A later document must score more than this."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 0

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        if len(docs) > self.k:  # the k best of them, and all that equal the last
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            docs, scores = docs[scores >= edge], scores[scores >= edge]
        rows = self.rows + list(zip((-scores).tolist(), docs.tolist(), strict=True))
        self.rows = nsmallest(self.k, rows)


def score_range(heap: Heap, lists: list[tuple[int, PostingList]], start: int, end: int) -> None:
    """Add the documents from ``start`` to before ``end`` to a query's heap. ``lists``: weight and
    list of each of its terms, by ascending largest contribution."""
    bounds = np.cumsum([w * p.bound for w, p in lists])
    least = heap.least
    essential = int(np.searchsorted(bounds, least, side="right"))  # those before cannot reach it together
    if essential == len(lists):
        return
    total = np.zeros(end - start, np.int64)
    touched = np.zeros(end - start, bool)
    for weight, postings in lists[essential:]:
        docs, impacts = postings.within(start, end)
        total[docs - start] += weight * impacts
        touched[docs - start] = True
    docs = np.flatnonzero(touched)
    scores = total[docs]
    for k in range(essential - 1, -1, -1):
        alive = scores + bounds[k] > least
        docs, scores = docs[alive], scores[alive]
        if not len(docs):
            return
        weight, postings = lists[k]
        rest = bounds[k - 1] if k else 0
        # the block that may hold each candidate, if any
        at = np.searchsorted(postings.last, docs + start)
        may = at < len(postings.last)
        may[may] = postings.first[at[may]] <= docs[may] + start
        peak = np.zeros(len(docs), np.int64)
        peak[may] = weight * postings.peak[at[may]]
        alive = scores + peak + rest > least
        docs, scores, at, may = docs[alive], scores[alive], at[alive], may[alive]
        for block in np.unique(at[may]).tolist():
            held, impacts = postings.block(block)
            here = np.flatnonzero(may & (at == block))
            place = np.searchsorted(held, docs[here] + start)
            equal = held[np.minimum(place, len(held) - 1)] == docs[here] + start
            scores[here[equal]] += weight * impacts[place[equal]]
    alive = scores > least
    if alive.any():
        heap.add(docs[alive] + start, scores[alive])


def search_shard(lists: dict[int, PostingList], queries: dict, size: int, k: int) -> dict:
    """The heap of every query: ``queries`` maps a key to (weight, term) pairs."""
    found = {}
    for key, terms in queries.items():
        mine = [(w, lists[t]) for w, t in terms if w > 0]
        mine.sort(key=lambda pair: pair[0] * pair[1].bound)
        heap = Heap(k)
        for start in range(0, size, RANGE):
            score_range(heap, mine, start, min(start + RANGE, size))
        found[key] = heap.rows
    return found


def search(index: tuple[DataFrame, DataFrame], items: DataFrame, k: int = 10, **columns: str) -> DataFrame:
    """``item_id, query, rank, doc_id, score``: the ``k`` best documents of every query."""
    documents, lists = index
    sums = documents.select(F.explode("lengths").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    corpus = Corpus(int(sums[0] or 0), int(sums[1] or 0))
    asked = stored(query_terms(items, **columns))
    groups = max(1, math.ceil(asked.select("query").distinct().count() / QUERIES))
    wanted = asked.select("term").distinct()
    df = lists.select("term", "n").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    users = (
        asked.join(df, "term")
        .withColumn("weight", _weight(corpus.documents, F.col("df")) * F.col("repeats"))
        .withColumn("part", F.pmod("query", F.lit(groups)).cast("int"))
        .groupBy("part", "term")
        .agg(F.collect_list(F.struct("item_id", "query", "weight")).alias("users"))  # QUERIES or so
    )
    users = stored(users)
    met = lists.select("shard", "term", "blocks").join(users, "term")
    met = met.select("shard", "part", "term", "blocks", "users", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<int>").alias("lengths"))
    every = documents.select("shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "ids", "lengths")
    kinds = {f.name: f.dataType for f in met.schema.fields}
    every = every.select("shard", "part", *[F.lit(None).cast(kinds[c]).alias(c) for c in ("term", "blocks", "users")], "ids", "lengths")

    def find(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        own = group.filter(pa.compute.is_valid(group.column("ids")))
        ids = own.column("ids").combine_chunks().flatten().to_numpy()
        lengths = own.column("lengths").combine_chunks().flatten().to_numpy()
        rows = group.filter(pa.compute.is_valid(group.column("term")))
        blocks = rows.column("blocks").combine_chunks()
        posted, queries = {}, {}
        for at, (term, asking) in enumerate(zip(rows.column("term").to_pylist(), rows.column("users").to_pylist(), strict=True)):
            posted[term] = PostingList(blocks[at].values, lengths, corpus)
            for user in asking:
                queries.setdefault((user["query"], user["item_id"]), []).append((user["weight"], term))
        out = [
            (item, query, None if ids[doc] == NO_ID else int(ids[doc]), -score)
            for (query, item), heap in search_shard(posted, queries, len(ids), k).items()
            for score, doc in heap
        ]
        columns = zip(*out, strict=True) if out else [()] * 4
        arrays = [pa.array(c, pa.int64()) for c in columns]
        give_back()
        return pa.table(arrays, names=["item_id", "query", "doc_id", "score"])

    heaps = met.unionByName(every).groupBy("shard", "part").applyInArrow(find, "item_id long, query long, doc_id long, score long")
    order = Window.partitionBy("item_id", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "query", "rank", "doc_id", "score")


def ranked_sql(k: int = 10) -> str:
    """The same ranking in a second engine, for queries of distinct ids."""
    words = (
        "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
    )
    return f"""
WITH t AS (SELECT doc_id, {words} FROM documents)
, n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id)
, c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n)
, q AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {words} FROM benchmark) GROUP BY ALL)
, p AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL)
, w AS (SELECT term, CAST(floor(1000e0 * ln((2 * max(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term)
, s AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc_id), c GROUP BY ALL)
, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}"""
