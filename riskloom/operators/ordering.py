"""Global order, ranks and running totals without a single-task window.

A total order is cut into range partitions by Spark's sort. The cut is balanced even
when one group holds most rows, as long as the order ends in a unique column. Each
row keeps the number of its part and its place in it; what earlier parts add is a
table with one row per (group, part), so only that small table is scanned in order.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from riskloom.session import stored

_PLACE_BITS = 33


def place_in_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Add ``_part`` and ``_place``: the sorted part a row lies in and its place there.

    The result is stored: sort bounds come from a sample, and both the totals
    per part and the rows themselves must see the same cut.
    """
    placed = stored(
        df.sort(*order).withColumn("_seen", F.monotonically_increasing_id())
    )
    return placed.select(
        *[c for c in placed.columns if c != "_seen"],
        F.shiftright("_seen", _PLACE_BITS).cast("int").alias("_part"),
        F.col("_seen").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place"),
    )


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the left side's keys are kept."""
    named = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_same_{k}" for k in keys])


def before_part(
    placed: DataFrame,
    group: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    with_total: bool = False,
) -> DataFrame:
    """Per (group, part): what all earlier parts of the group hold.

    ``_before_<name>`` is the sum (or maximum) over earlier parts; ``_total_<name>``
    the sum over all parts. Rows are pre-aggregated inside each part by Spark's
    partial aggregation, so the ordered scan sees one row per (group, part).
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    per_part = placed.groupBy(*group, "_part").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max(c).alias(n) for n, c in maxima.items()],
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums]
    columns += [F.max(n).over(earlier).alias(f"_before_{n}") for n in maxima]
    if with_total:
        columns += [F.sum(n).over(whole).alias(f"_total_{n}") for n in sums]
    return per_part.select(*group, "_part", *columns)


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    group: Sequence[str] = (),
    following: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums ``cum_<name>`` in the given order, with group totals
    ``total_<name>`` and, for columns in ``following``, their value in the next row of
    the group as ``next_<column>``. ``order`` must be unique inside a group."""
    group = list(group)
    placed = place_in_order(df, [*group, *order])
    per_part = before_part(placed, group, sums, with_total=True)
    if following:
        per_part = join_same(per_part, _next_part_head(placed, group, following), [*group, "_part"])
    carried = join_same(placed, per_part, [*group, "_part"])
    place = Window.partitionBy(*group, "_part").orderBy("_place")
    here = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_part = F.lead(F.struct(*following)).over(place) if following else None
    return carried.select(
        *df.columns,
        *[(F.col(f"_before_{n}") + F.sum(c).over(here)).alias(f"cum_{n}") for n, c in sums.items()],
        *[F.col(f"_total_{n}").alias(f"total_{n}") for n in sums],
        *[F.coalesce(in_part, F.col("_head"))[c].alias(f"next_{c}") for c in following],
    )


def _next_part_head(placed: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per (group, part): the first row of the group's next part."""
    heads = placed.groupBy(*group, "_part").agg(F.min_by(F.struct(*columns), "_place").alias("_own_head"))
    parts = Window.partitionBy(*group).orderBy("_part")
    return heads.select(*group, "_part", F.lead("_own_head").over(parts).alias("_head"))


def ranked(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = ()) -> DataFrame:
    """Add ``_rank``, the 0-based position of a row in the order (inside its group),
    and keep ``_part`` / ``_place``."""
    group = list(group)
    placed = place_in_order(df, [*group, *order])
    if not group:
        # the place inside the part is the rank inside it; no second shuffle
        starts = before_part(placed, [], {"rows": F.lit(1)})
        return placed.join(starts, ["_part"]).select(
            *df.columns, "_part", "_place",
            (F.col("_before_rows") + F.col("_place")).alias("_rank"),
        )
    # first place of the group inside each part, and its rows in earlier parts
    firsts = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"))
    starts = join_same(before_part(placed, group, {"rows": F.lit(1)}), firsts, [*group, "_part"])
    return join_same(placed, starts, [*group, "_part"]).select(
        *df.columns, "_part", "_place",
        (F.col("_before_rows") + F.col("_place") - F.col("_first")).alias("_rank"),
    )


def rank_blocks(df: DataFrame, block_rows: int, overlap: int) -> DataFrame:
    """Cut a ranked frame into blocks of consecutive rows for windows of bounded reach.

    Adds ``_block`` and ``_own``. Each block also gets the ``overlap`` rows before it,
    marked ``_own`` = false, so a window that looks back that far needs no other block."""
    if block_rows < overlap:
        raise ValueError("a block must hold at least the overlap")
    own = F.floor(F.col("_rank") / block_rows).cast("bigint")
    copies = F.when(
        F.col("_rank") % block_rows >= block_rows - overlap, F.array(own, own + 1)
    ).otherwise(F.array(own))
    return df.withColumn("_block", F.explode(copies)).withColumn("_own", F.col("_block") == own)


def time_blocks(df: DataFrame, group: str, time: str, block_rows: int, reach: int) -> DataFrame:
    """Cut a ranked frame as ``rank_blocks`` does; a block also gets all rows from ``reach``
    before the time of its first row on.

    How many later blocks a row goes to follows from the first times of the group's blocks,
    one row per block. Blocks whose whole reach lies within them cost no copy."""
    own = F.floor(F.col("_rank") / block_rows).cast("bigint")
    placed = df.withColumn("_own_block", own)
    firsts = placed.groupBy(group, "_own_block").agg(F.min(time).alias("_starts"), F.max(time).alias("_ends"))
    along = Window.partitionBy(group).orderBy("_own_block")
    # the last block that reaches back to the newest row of this one
    reached = firsts.select(
        F.col(group).alias("_group"), F.col("_own_block").alias("_from"), F.col("_ends"),
        F.collect_list(F.col("_starts")).over(along.rowsBetween(1, MOST_REACHED)).alias("_later"),
    )
    reached = reached.withColumn("_later", F.filter("_later", lambda t: t - reach <= F.col("_ends")))
    at = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_own_block") == F.col("_from"))
    met = placed.join(reached.drop("_ends"), at).drop("_group", "_from")
    last = (F.col("_rank") % block_rows == block_rows - 1).cast("int")  # the row before the next block's first
    copies = F.greatest(F.size(F.filter("_later", lambda t: t - reach <= F.col(time))), last)
    full = F.size("_later") >= MOST_REACHED
    checked = F.when(full, F.raise_error(F.lit("a look-back reaches over too many blocks; raise block_rows")).cast("int"))
    blocks = F.sequence(F.col("_own_block"), F.col("_own_block") + F.coalesce(checked, copies))
    exploded = met.withColumn("_block", F.explode(blocks)).withColumn("_own", F.col("_block") == F.col("_own_block"))
    return exploded.drop("_own_block", "_later")


MOST_REACHED = 10_000


def exact_quantiles(df: DataFrame, fractions: Sequence[float], group: Sequence[str], value: str) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group, as (group, fraction, quantile).

    Counts equal values first, then finds the two middle values by running counts, so
    no task holds the values of a whole group."""
    group = list(group)
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("rows"))
    )
    totals = running_totals(counts, [value], {"rows": F.col("rows")}, group=group, following=[value])
    wanted = totals.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    at = F.col("fraction") * (F.col("total_rows") - 1)
    low = F.floor(at)
    first, last = F.col("cum_rows") - F.col("rows"), F.col("cum_rows") - 1
    upper = F.when(low + 1 <= last, F.col(value)).otherwise(F.coalesce(F.col(f"next_{value}"), F.col(value)))
    return wanted.where((low >= first) & (low <= last)).select(
        *group, "fraction", (F.col(value) + (upper - F.col(value)) * (at - low)).alias("quantile")
    )


SAMPLE_ROWS = 1_000_000


def rows_at(
    df: DataFrame, order: Sequence[str], positions: Sequence[int], rows: int, sample_rows: int = SAMPLE_ROWS
) -> dict[int, Row]:
    """The order keys at the given 0-based positions of the whole order of ``rows`` rows.

    On a large frame a hash sample first brackets each position by values of the leading
    order column; exact counts below the bracket then say where in it the position lies,
    and only the bracket (about one percent of the rows) is sorted. A position outside
    its bracket is looked up by sorting everything."""
    positions = [p for p in dict.fromkeys(positions) if 0 <= p < rows]
    keys = df.select(*order)
    found: dict[int, Row] = {}
    if rows > 2 * sample_rows:
        found = _rows_by_bracket(keys, order, positions, rows, sample_rows)
    missing = [p for p in positions if p not in found]
    return found | _rows_by_sort(keys, order, missing)


def _rows_by_sort(keys: DataFrame, order: Sequence[str], positions: Sequence[int]) -> dict[int, Row]:
    if not positions:
        return {}
    hits = ranked(keys, order).where(F.col("_rank").isin(*positions)).select("_rank", *order)
    return {r["_rank"]: r for r in hits.collect()}


def _rows_by_bracket(
    keys: DataFrame, order: Sequence[str], positions: Sequence[int], rows: int, sample_rows: int
) -> dict[int, Row]:
    lead = F.col(order[0])
    nulls = keys.where(lead.isNull()).count()  # they come first
    found = {}
    for position in [p for p in positions if p < nulls]:
        hit = _rows_by_sort(keys.where(lead.isNull()), order, [position])
        found |= {position: row for row in hit.values()}
    later = [p for p in positions if p >= nulls]
    sampled = keys.where(lead.isNotNull() & (F.pmod(F.xxhash64(*order), F.lit(rows)) < sample_rows))
    # five standard errors of a sampled rank on either side, were all rows with a value
    margin = 2.5 / (sample_rows * max(rows - nulls, 1) / rows) ** 0.5
    shares = [(p - nulls) / max(rows - nulls, 1) for p in later]
    ends = [min(max(share + side, 0.0), 1.0) for share in shares for side in (-margin, margin)]
    if not ends:
        return found
    values = sampled.agg(F.percentile_approx(lead, F.array(*[F.lit(e) for e in ends]), 100_000)).first()[0]
    if values is None:
        return found
    kind = keys.schema[order[0]].dataType
    brackets = [
        (p, F.lit(values[2 * i]).cast(kind), F.lit(values[2 * i + 1]).cast(kind)) for i, p in enumerate(later)
    ]
    below = keys.agg(
        *[F.count_if(lead.isNull() | (lead < low)).alias(f"b{i}") for i, (_, low, _) in enumerate(brackets)]
    ).first()
    for i, (position, low, high) in enumerate(brackets):
        inside = position - below[f"b{i}"]
        if inside >= 0:
            hit = _rows_by_sort(keys.where((lead >= low) & (lead <= high)), order, [inside])
            found |= {position: row for row in hit.values()}
    return found


def key_of(df: DataFrame, row, names: Sequence[str]) -> tuple[Column, Column]:
    """The order key of every row, and that of one found row, as comparable structs."""
    literals = [F.lit(row[n]).cast(df.schema[n].dataType).alias(n) for n in names]
    return F.struct(*names), F.struct(*literals)
