"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

A row's key (by default its text, so that equal texts lie together) has a place on the
ring and belongs to the next virtual node clockwise; a shard owns several of them. No
shard takes more than its bound: the rows of an arc that no longer fit go on to the next
shard clockwise that has room. The bounds add up to the number of rows, so row counts
differ by one at most, and rows move only where a bound or an arc changed.

The work is done in counts. Rows are counted per arc and cut into cells of about
``CELL_ROWS`` rows by a hash of the row; running totals over cells, in two levels, and a row
number inside each cell rank every row within its arc. Equal rows share a hash: where more
than ``CELL_ROWS`` of them fill a cell, they are dealt over parts of their own behind it. Where the arcs' rows go follows from the arc
counts alone, a table of (shards × virtual nodes) rows. A hot key fills many cells of one
arc and spills over many shards, so no task holds it whole.

Edge cases: a null key falls in the arc of the empty key; a null text has size 1; ties of
the row hash fall back on id, size and checksum, so repeated rows take neighbouring slots;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import stored
from riskloom.session import broadcast_if_small

VIRTUAL_NODES = 64
CELL_ROWS = 1_000
CELLS_PER_BLOCK = 1_000
RING = 1 << 60


def ring_nodes(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in ring order; a shard's places depend on its number alone."""
    return sorted(
        (int(md5(f"shard {s} node {v}".encode()).hexdigest()[:15], 16), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )


def ring_place(key: Column) -> Column:
    """Place of a key on the ring: 60 bits of its md5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def bounds(rows: int, shards: int) -> list[int]:
    """The most rows of each shard: the even share, and one more for the first few."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def overflow_plan(counts: dict[int, int], owners: list[int], most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, first rank, end rank, shard, first slot).

    Round by round, what is left of every arc is offered to the node one step further
    clockwise; a shard takes arcs in ring order until it is full."""
    taken = [0] * len(most)
    left = {a: (0, n) for a, n in sorted(counts.items()) if n}  # arc -> ranks [first, end)
    plan = []
    for step in range(len(owners)):
        if not left:
            break
        for arc, (first, end) in list(left.items()):
            shard = owners[(arc + step) % len(owners)]
            room = min(most[shard] - taken[shard], end - first)
            if room:
                plan.append((arc, first, first + room, shard, taken[shard]))
                taken[shard] += room
                left[arc] = (first + room, end)
                if first + room == end:
                    del left[arc]
    return plan


def _arc_table(spark: SparkSession, nodes: list[tuple[int, int]]) -> tuple[DataFrame, int]:
    """``sector, low, high, arc``: the ring in equal sectors, each cut at the nodes in it.
    It has sectors + nodes rows, whatever the data."""
    sectors = 1 << (4 * len(nodes)).bit_length()
    places = [p for p, _ in nodes]
    cuts = sorted({*(RING // sectors * s for s in range(sectors + 1)), *(p + 1 for p in places if p + 1 < RING)})
    rows = [
        (low * sectors // RING, low, high - 1, bisect_left(places, low) % len(nodes))
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]
    return spark.createDataFrame(rows, "sector long, low long, high long, arc int"), sectors


def shard_rows(
    rows: DataFrame, key: Column, shards: int = 8, virtual_nodes: int = VIRTUAL_NODES, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` (gapless from 0) and ``home_shard``, the choice of the
    ring alone. Give it a narrow frame: id and what else is wanted, not the texts."""
    spark = rows.sparkSession
    nodes = ring_nodes(shards, virtual_nodes)
    owners = [s for _, s in nodes]
    table, sectors = _arc_table(spark, nodes)
    row = rows.select(
        F.struct("*").alias("row"),
        ring_place(key).alias("place"),
        F.xxhash64(*rows.columns).alias("order"),
        F.monotonically_increasing_id().alias("salt"),  # stored with the row, so it stays the same
    )
    sector = F.shiftright("place", 60 - (sectors.bit_length() - 1))
    near = (sector == F.col("sector")) & F.col("place").between(F.col("low"), F.col("high"))
    placed = stored(row).join(F.broadcast(table), near).select("row", "order", "salt", "arc")

    arcs = {r["arc"]: r["n"] for r in placed.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    plan = overflow_plan(arcs, owners, bounds(sum(arcs.values()), shards))
    homes = spark.createDataFrame(
        [(a, owners[a], max(1, -(-n // cell_rows))) for a, n in arcs.items()], "arc int, home_shard int, cells int"
    )
    goes = spark.createDataFrame(plan, "start int, first long, end long, shard int, first_slot long")

    celled = placed.join(F.broadcast(homes), "arc").withColumn("cell", F.pmod("order", "cells"))
    celled = _split_equal_rows(celled, cell_rows)
    part = ["arc", "cell", "equal", "part"]
    by_part = Window.partitionBy(*part).orderBy("order", "row")
    numbered = celled.withColumn("number", F.row_number().over(by_part) - 1)
    offsets = _offsets(celled.groupBy(*part).agg(F.count("*").alias("n")), part[1:])
    ranked = numbered.join(offsets, part)
    ranked = ranked.withColumn("rank", F.col("offset") + F.col("number"))
    here = (F.col("arc") == F.col("start")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    slot = F.col("first_slot") + F.col("rank") - F.col("first")
    fields = [F.col("row").getField(c).alias(c) for c in rows.columns]
    return ranked.join(F.broadcast(goes), here).select(*fields, "shard", slot.alias("slot"), "home_shard")


def _split_equal_rows(celled: DataFrame, cell_rows: int) -> DataFrame:
    """``celled`` with ``equal`` and ``part``: 0 and 0, or for rows of which more than ``cell_rows`` are
    equal in an overfull cell, their hash (never 0) and one of as many parts as they need. There are at most
    (rows / ``cell_rows``) such hashes."""
    full = celled.groupBy("arc", "cell").agg(F.count("*").alias("n")).where(F.col("n") > 4 * cell_rows)
    full = broadcast_if_small(stored(full.select("arc", "cell")))
    many = celled.join(full, ["arc", "cell"]).groupBy("arc", "cell", "order").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / cell_rows).alias("parts")
    hot = broadcast_if_small(stored(many.where(F.col("n") > cell_rows).select("arc", "cell", "order", parts)))
    rows = celled.join(hot, ["arc", "cell", "order"], "left")
    equal = F.when(F.col("parts").isNull(), 0).when(F.col("order") == 0, 1).otherwise(F.col("order"))
    dealt = F.coalesce(F.pmod(F.xxhash64("salt"), F.col("parts")), F.lit(0))
    return rows.select("row", "order", "arc", "home_shard", "cell", equal.alias("equal"), dealt.alias("part"))


def _offsets(counts: DataFrame, order: list[str]) -> DataFrame:
    """``counts`` (arc, ``order``, n) with the rows of the arc that stand before: totals of blocks of
    cells first, then of the cells of one block, so that no task sees all cells of an arc. The rows of
    a cell that are not dealt over parts come first in it."""
    counts = stored(counts.withColumn("block", F.floor(F.col("cell") / CELLS_PER_BLOCK)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sequence = ["cell", F.col("equal") != 0, *order[1:]]
    within = before.partitionBy("arc", "block").orderBy(*sequence)
    blocks = counts.groupBy("arc", "block").agg(F.sum("n").alias("n")).select(
        "arc", "block", F.coalesce(F.sum("n").over(before.partitionBy("arc").orderBy("block")), F.lit(0)).alias("start")
    )
    cells = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(blocks, ["arc", "block"])
    return cells.select("arc", *order, (F.col("start") + F.col("inside")).alias("offset"))
