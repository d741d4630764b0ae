"""Line deduplication by the frequency of a line within its site.

For every host the pages that hold a line are divided by the host's pages; a line above
``ratio``, on ``min_pages`` pages at least, is boilerplate of that host and leaves all its
pages. Lines are counted under 128 bits of hash, once a page, and summed before and after
the shuffle, so a host or a line with a third of all rows costs no task more than another.
A host's boilerplate lines are few: each takes at least ``ratio`` of its pages, so there
are at most (lines per page / ratio). They travel to the pages as one array per host.

Edge cases: pages with a null host belong to no site and stay as they are; a null text
stays null; an empty text stays empty; blank lines are never boilerplate; a page that
repeats a line counts once; a text of which every line goes becomes empty; lines are cut
at line feeds and compared without surrounding white space; repeated rows are pages of
their own; other columns, whatever their names, are kept.

With ``copies_once`` the pages of a host that hold the same lines (order, repeats, blank lines
and surrounding white space aside) count as one page, in the pages with a line and in the
host's pages alike, so that copies of a document do not vote for their own lines.
``confirmed_lines`` does the same for groups of pages that the caller names, such as near copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

BOILERPLATE_RATIO = 0.1
MIN_PAGES = 3
WHITE = " \t\r\n\v\f"
BROADCAST_KEYS = 100_000  # of 16 bytes


def line_key(line: Column) -> Column:
    """128 bits of hash of the line without surrounding white space; null for blank lines."""
    text = F.btrim(line, F.lit(WHITE))
    return F.when(text != "", F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")))


def line_keys(text: Column) -> Column:
    """The keys of a text's different lines; null stands for the blank ones."""
    return F.array_distinct(F.transform(F.split(text.cast("string"), "\n"), line_key))


def page_key(keys: str) -> Column:
    """128 bits of hash of the lines of a page, whatever their order."""
    held = F.array_sort(F.filter(keys, lambda k: k.isNotNull()))
    return F.struct(F.xxhash64(held).alias("a"), F.xxhash64(held, F.lit(1)).alias("b"))


def boilerplate_lines(
    pages: DataFrame,
    host: Column,
    text: Column,
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``host, key, pages, host_pages`` of each boilerplate line."""
    rows = pages.select(host.alias("host"), line_keys(text).alias("keys")).where(F.col("host").isNotNull())
    if copies_once:
        rows = stored(rows.groupBy("host", page_key("keys").alias("page")).agg(F.first("keys").alias("keys")))
    totals = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        rows.select("host", F.explode("keys").alias("key"))
        .where(F.col("key").isNotNull())
        .groupBy("host", "key")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    return counts.join(totals, "host").where(F.col("pages") > ratio * F.col("host_pages"))


def host_lines(found: DataFrame) -> DataFrame:
    """``site, keys``: the lines found for each host, to be sent to the pages if they are few."""
    sites = stored(found.groupBy(F.col("host").alias("site")).agg(F.collect_list("key").alias("keys")))
    small = (sites.agg(F.sum(F.size("keys"))).first()[0] or 0) <= BROADCAST_KEYS
    return F.broadcast(sites) if small else sites  # else the join splits a large host's pages


def pages_with_lines(pages: DataFrame, sites: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The pages that hold a line of ``sites`` (of ``host_lines``)."""
    packed = pages.select(F.struct("*").alias("row"))
    rows = packed.join(sites, F.col("row").getField(host) == F.col("site"))
    held = rows.where(F.arrays_overlap("keys", line_keys(F.col("row").getField(text))))
    return held.select(*(F.col("row").getField(c).alias(c) for c in pages.columns))


def confirmed_lines(
    pages: DataFrame,
    sites: DataFrame,
    groups: DataFrame,
    id_col: str,
    host: Column,
    text: Column,
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``host, key`` of the lines of ``sites`` (of ``host_lines``) that are boilerplate also when the
    pages of a group count as one page; ``groups`` has a ``page_id`` and its ``page_group``. Pages
    without a group count by their lines."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), line_keys(text).alias("lines"))
    rows = rows.join(sites, F.col("host") == F.col("site"))
    narrow = rows.select("id", "host", page_key("lines").alias("lines_key"), F.array_intersect("keys", "lines").alias("keys"))
    grouped = narrow.join(groups, F.col("id") == F.col("page_id"), "left")
    page = F.struct("page_group", F.when(F.col("page_group").isNull(), F.col("lines_key")).alias("lines_key"))
    # a null key stands for the page itself
    keys = F.concat("keys", F.array(F.lit(None).cast("struct<a:bigint,b:bigint>")))
    votes = grouped.select("host", page.alias("page"), F.explode(keys).alias("key")).distinct()
    counts = stored(votes.groupBy("host", "key").agg(F.count("*").alias("pages")))
    totals = counts.where(F.col("key").isNull()).select("host", F.col("pages").alias("host_pages"))
    lines = counts.where(F.col("key").isNotNull() & (F.col("pages") >= min_pages)).join(totals, "host")
    return lines.where(F.col("pages") > ratio * F.col("host_pages")).select("host", "key")


def drop_lines(
    pages: DataFrame, sites: DataFrame, host: str = "source", text: str = "text", dropped: str | None = None
) -> DataFrame:
    """``pages`` with the lines of ``sites`` (of ``host_lines``) taken out of ``text``; ``dropped``
    names a column for the number of lines that went."""
    packed = pages.select(F.struct("*").alias("row"))
    rows = packed.join(sites, F.col("row").getField(host) == F.col("site"), "left")
    old = F.col("row").getField(text).cast("string")
    lines = F.split(old, "\n")
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("keys", line_key(x)), F.lit(False)))
    cleaned = rows.withColumn("kept", F.when(F.col("keys").isNotNull(), kept))
    new = F.coalesce(F.array_join("kept", "\n"), old)
    out = [new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in pages.columns]
    if dropped is not None:
        out.append(F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).alias(dropped))
    return cleaned.select(*out)


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
    dropped: str | None = None,
    copies_once: bool = False,
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``; ``dropped`` names a column
    for the number of lines that went, ``copies_once`` counts pages with the same lines once."""
    found = boilerplate_lines(pages, F.col(host), F.col(text), ratio, min_pages, copies_once)
    return drop_lines(pages, host_lines(found), host, text, dropped)


def cleaned_sql(columns: str = "doc_id, lang, source", ratio: float = BOILERPLATE_RATIO, min_pages: int = MIN_PAGES,
                table: str = "documents", extra: str = "") -> str:
    """The same for ``text`` and ``source`` of a table with unique ``doc_id``, in plain SQL."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS place
  FROM {table} WHERE text IS NOT NULL),
keyed AS (SELECT *, trim(line, {white}) AS key FROM lines),
found AS (
  SELECT source, key FROM keyed JOIN (SELECT source, count(*) AS n FROM {table} GROUP BY source) USING (source)
  WHERE key <> '' GROUP BY source, key, n
  HAVING count(DISTINCT doc_id) >= {min_pages} AND count(DISTINCT doc_id) > {ratio} * n),
marked AS (SELECT keyed.*, found.key IS NOT NULL AS gone FROM keyed LEFT JOIN found USING (source, key)),
texts AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept,
         CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_dropped
  FROM marked GROUP BY doc_id)
SELECT {columns}, kept AS text, CAST(length(kept) AS BIGINT) AS n_chars{extra}
FROM {table} LEFT JOIN texts USING (doc_id)"""
