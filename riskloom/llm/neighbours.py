"""Nearest neighbours by inner product over shifted Hilbert curves.

Vectors get one more coordinate that makes all norms equal, which turns the largest inner
product into the nearest vector. Each of several random projections to a few dimensions is
shifted and ordered by a Hilbert curve; Spark range-partitions (curve, key) and sorts, and
every query is compared with its neighbours in each order. The windows' answers merge, and
their k-th best score is a bound for the query.

The bound then completes the answer: the rows lie in blocks of Hilbert neighbours with
centre and radius, and so do the queries. A pair of blocks is looked at only if the largest
inner product between the two balls reaches the lowest bound of its queries. On clustered
vectors few pairs are left; on vectors without structure most are, and the search becomes
the stated queries against all rows, in blocks. The result is exact either way.

Equal vectors are searched once, as a class; of a class at most k + 1 smallest ids matter,
which are picked before and after the shuffle. Queries of one class share its answer.

Edge cases: vectors that are null, empty, zero or hold null or non-finite numbers take no
part, nor do those of another length than the most frequent (the shorter at a tie) or rows
with a null id; fewer than k other vectors give what there is; ties go to the smaller id;
repeated (id, vector) rows count once, and an id with several vectors is a candidate for
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import small_batches, stored

CURVES = 8
PROJECTED = 6
BITS = 10  # per projected dimension; PROJECTED * BITS fit a long
WINDOW = 64  # neighbours on either side
BLOCK = 4096
RANGE_ROWS = 20_000
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of cell numbers along the Hilbert curve of its grid."""
    x = cells.astype(np.int64).copy()
    n, dims = x.shape
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for i in range(dims):
            turn = (x[:, i] & bit) != 0
            swap = np.where(turn, 0, (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(turn, below, swap)
            x[:, i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[:, dims - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _frames(length: int, curves: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (curve, PROJECTED, length + 1) and shifts of the curves."""
    draw = np.random.default_rng(SEED)
    directions = [
        np.linalg.qr(draw.normal(size=(length + 1, min(PROJECTED, length + 1))))[0].T for _ in range(curves)
    ]
    return np.stack(directions), draw.uniform(0, 0.5, size=(curves, directions[0].shape[0]))


def _matrix(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 1))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v array<double>`` of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = (
        F.col("vec_id").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = rows.where(F.coalesce(fit, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "length").limit(1).first()
    return rows.where(F.size("v") == (common["length"] if common else 0))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    window: int = WINDOW,
    complete: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows of each query.

    ``is_query`` is a condition on ``vec_id``. ``complete=False`` returns what the windows found."""
    small_batches(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    classes = rows.groupBy("v").agg(F.min("vec_id").alias("class"), F.max(is_query.cast("int")).alias("asked"))
    sample = rows.select(F.size("v").alias("length")).first()
    length = sample["length"] if sample else 1
    classes = stored(classes.select("class", (F.col("asked") == 1).alias("asked"), "v"))
    directions, shifts = _frames(length, curves)
    norm = classes.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 1.0

    def raised(x: np.ndarray, asked: bool) -> np.ndarray:
        """With the coordinate that makes norms equal; queries are scaled to that norm."""
        square = (x * x).sum(axis=1, keepdims=True)
        if asked:
            return np.hstack([x * np.sqrt(norm / square), np.zeros((len(x), 1))])
        return np.hstack([x, np.sqrt(np.maximum(norm - square, 0))])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(shifts.shape, np.inf), np.full(shifts.shape, -np.inf)
        for batch in batches:
            if batch.num_rows:
                y = np.einsum("cpd,nd->ncp", directions, raised(_matrix(batch), False))
                low, high = np.minimum(low, y.min(axis=0)), np.maximum(high, y.max(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(low.size)), pa.array(low.reshape(-1)), pa.array(high.reshape(-1))],
            names=["place", "low", "high"],
        )

    found = classes.select("v").mapInArrow(spans, "place long, low double, high double")
    span = {r["place"]: r for r in found.groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    low = np.array([span[p]["low"] if p in span else 0.0 for p in range(shifts.size)]).reshape(shifts.shape)
    high = np.array([span[p]["high"] if p in span else 1.0 for p in range(shifts.size)]).reshape(shifts.shape)
    width = np.where(high > low, high - low, 1.0)

    def keys(x: np.ndarray, curve: int, asked: bool) -> np.ndarray:
        y = (raised(x, asked) @ directions[curve].T - low[curve]) / width[curve]
        cells = (np.clip(y, 0, 1) / 2 + shifts[curve]) * (1 << BITS)
        return hilbert_keys(np.minimum(cells.astype(np.int64), (1 << BITS) - 1))

    def order(which: range) -> DataFrame:
        """``curve, key, asked, class, v``: each class once, and once more as a query if it is asked."""

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                asked = batch.filter(batch.column("asked"))
                for part, is_asked in ((batch, False), (asked, True)):
                    if part.num_rows:
                        x = _matrix(part)
                        for curve in which:
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(x), curve, np.int32)),
                                    pa.array(keys(x, curve, is_asked)),
                                    pa.array(np.full(len(x), is_asked)),
                                    part.column("class"),
                                    part.column("v"),
                                ],
                                names=["curve", "key", "asked", "class", "v"],
                            )

        return classes.mapInArrow(emit, "curve int, key long, asked boolean, class long, v array<double>")

    total = classes.count()
    parts = max(1, -(-total * curves // RANGE_ROWS))
    ranged = order(range(curves)).repartitionByRange(parts, "curve", "key", "class")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        batch = _joined(held)
        x, number = _matrix(batch), batch.column("class").to_numpy()
        curve, asked = batch.column("curve").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
        for c in np.unique(curve):
            rows_of = np.flatnonzero((curve == c) & ~asked)
            at = np.flatnonzero((curve == c) & asked)
            place = np.searchsorted(rows_of, at)
            found = [
                _best(x[q], number[q], x[near], number[near], k)
                for q, near in (
                    (q, rows_of[max(0, p - window) : p + window]) for q, p in zip(at.tolist(), place.tolist(), strict=True)
                )
            ]
            yield _scored(number[at], found)

    shape = "query long, class long, score double"
    met = ranged.sortWithinPartitions("curve", "key", "class").mapInArrow(compare, shape)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    # products of one pair may differ in the last place from curve to curve
    met = met.groupBy("query", "class").agg(F.max("score").alias("score"))
    first = stored(met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k))
    if complete:
        first = _completed(classes, order(range(1)), first, total, k)
    return _expanded(rows, classes, first, is_query, k)


def _best(q: np.ndarray, own: int, x: np.ndarray, number: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    score = np.where(number == own, -np.inf, x @ q)
    top = np.argsort(-score, kind="stable")[:k]
    top = top[score[top] > -np.inf]
    return number[top], score[top]


def _scored(queries: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    counts = [len(f[0]) for f in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(queries, counts).astype(np.int64)),
            pa.array(np.concatenate([np.empty(0, np.int64), *(f[0] for f in found)])),
            pa.array(np.concatenate([np.empty(0), *(f[1] for f in found)])),
        ],
        names=["query", "class", "score"],
    )


BALL = "block long, numbers binary, vectors binary, limits binary, centre array<double>, radius double, least double"


def _balls(rows: DataFrame, total: int, parts_of: int) -> DataFrame:
    """Rows ``key, class, v, bound`` as blocks of Hilbert neighbours."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            batch = _joined(held)
            x, limit = _matrix(batch), batch.column("bound").to_numpy()
            centre = x.mean(axis=0)
            values = [
                (part << 32) + count,
                batch.column("class").to_numpy().tobytes(),
                x.tobytes(),
                limit.tobytes(),
                centre,
                float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max()),
                float(limit.min()),
            ]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds, strict=True)],
                names=["block", "numbers", "vectors", "limits", "centre", "radius", "least"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(BLOCK - sum(b.num_rows for b in held), batch.num_rows - at)
                held.append(batch.slice(at, take))
                at += take
                if sum(b.num_rows for b in held) == BLOCK:
                    yield block()
                    held, count = [], count + 1
        if held:
            yield block()

    parts = max(1, -(-total // parts_of))
    ranged = rows.repartitionByRange(parts, "key", "class").sortWithinPartitions("key", "class")
    return stored(ranged.select("class", "v", "bound").mapInArrow(fill, BALL))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _completed(classes: DataFrame, ordered: DataFrame, first: DataFrame, total: int, k: int) -> DataFrame:
    """The k best classes of each query among all rows, by blocks that its bound does not exclude."""
    bounds = first.where(F.col("n") == k).select(F.col("query").alias("class"), F.col("score").alias("bound"))
    asked = ordered.where("asked").join(bounds, "class", "left")
    asked = asked.withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    queries = _balls(asked, classes.where("asked").count(), BLOCK)
    data = _balls(ordered.where(~F.col("asked")).withColumn("bound", F.lit(0.0)), total, 4 * BLOCK)

    names = {r["block"]: i for i, r in enumerate(queries.select("block").orderBy("block").collect())}  # one per BLOCK queries
    if not names:
        return first.select("query", "class", "score")
    heads = queries.select("block", "centre", "radius", "least")
    every = data.select(F.col("block").alias("d_block"), F.col("centre").alias("d_centre"), F.col("radius").alias("d_radius"))
    wanted = F.explode(F.array(*(F.lit(b) for b in names)))
    most = (
        _dot("centre", "d_centre")
        + F.sqrt(_dot("centre", "centre")) * F.col("d_radius")
        + F.sqrt(_dot("d_centre", "d_centre")) * F.col("radius")
        + F.col("radius") * F.col("d_radius")
    )
    met = every.withColumn("block", wanted).join(heads, "block").where(most * (1 + 1e-9) + 1e-9 >= F.col("least"))
    left = met.select("block", "d_block").join(
        data.select(F.col("block").alias("d_block"), F.col("numbers").alias("d_numbers"), F.col("vectors").alias("d_vectors")),
        "d_block",
    )
    pairs = left.join(queries.select("block", "numbers", "vectors", "limits"), "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, d = np.frombuffer(row["numbers"], np.int64), np.frombuffer(row["d_numbers"], np.int64)
                limit = np.frombuffer(row["limits"], np.float64)
                x = np.frombuffer(row["vectors"], np.float64).reshape(len(q), -1)
                y = np.frombuffer(row["d_vectors"], np.float64).reshape(len(d), -1)
                for at in range(0, len(q), 256):
                    score = x[at : at + 256] @ y.T
                    score[q[at : at + 256, None] == d[None, :]] = -np.inf
                    # rounding may differ from the windows' products in the last places
                    good = score >= limit[at : at + 256, None] - 1e-9
                    found = []
                    for i in range(len(score)):
                        some = np.flatnonzero(good[i] & (score[i] > -np.inf))
                        top = some[np.lexsort((d[some], -score[i][some]))[:k]]
                        found.append((d[top], score[i][top]))
                    yield _scored(q[at : at + 256], found)

    searched = pairs.mapInArrow(search, "query long, class long, score double")
    both = searched.union(first.select("query", "class", "score"))
    single = both.groupBy("query", "class").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    return single.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")


def _expanded(rows: DataFrame, classes: DataFrame, found: DataFrame, is_query: Column, k: int) -> DataFrame:
    """From classes to ids: the members of the classes found and of the query's own."""
    members = stored(rows.join(classes.select("v", "class"), "v").select("vec_id", "class").distinct())
    smallest = Window.partitionBy("class").orderBy("vec_id")
    few = members.withColumn("m", F.row_number().over(smallest)).where(F.col("m") <= k + 1).select("class", "vec_id")
    own = classes.where("asked").select(
        F.col("class").alias("query"), "class", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x).alias("score")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = found.select("query", "class", "score").union(own).join(few, "class")
    # one more than k, since a query leaves itself out
    answers = answers.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    asked = members.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("class").alias("query"))
    mine = asked.join(answers.select("query", "vec_id", "score"), "query").where("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = mine.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
