"""WARC archives: written by Spark, normalised to one gzip member per record, read by offset.

``write_archives`` writes records as text files that Spark compresses as a whole: one gzip
stream per file, which can only be read from its start. ``normalise`` inflates each such
stream once, piece by piece, and writes every record as a gzip member of its own, with a
sidecar index of (offset, length, record id, type) beside the archive. ``read_records`` deals
the index entries to tasks, so that many tasks read one archive, each from its own offsets.

Archives and indexes lie in the shared folder, reached through ``pyarrow.fs``, so that any
store it knows will do. A task writes to a name of its own and moves the file when it is
whole; a task that is run again moves the same bytes to the same place.

Edge cases: a null payload is an empty one; payloads of any length pass in pieces when they are
normalised, and are held one at a time when read; a null id is written without the header that
names it and read as null; control characters in a target URI are percent-encoded and a null
URI is left out; repeated rows are records of their own, and rows that repeat the largest id
of a payload are all responses; an empty table gives archives without records; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import tidy
from riskloom.session import new_folder

# fixed values: the format of records
VERSION = "WARC/1.1"
GAP = "\r\n\r\n"  # ends a block of headers, and follows every record
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID_PREFIX, ID_SUFFIX = "<urn:riskloom:page:", ">"

PIECE = 1 << 18
LEVEL = 4
MOST_HEADER = 1 << 20
ENTRIES_PER_TASK = 4_000


# --- records of a table ------------------------------------------------------------


def base32_digest(payload: Column) -> Column:
    """The SHA-1 of a payload in upper-case base32, 32 letters."""
    hexed = F.sha1(payload)
    letters = []
    for group in range(8):  # five hexadecimal digits are four letters
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def page_records(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """``page_id, url, payload string, digest, refers_to``: of rows with equal payloads of at least
    ``least`` bytes, those with the largest id are responses (``refers_to`` null), the others
    refer to it. A payload that many rows share is one row of the aggregate."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_digest(F.col("payload").cast("binary")))
    large = rows.where(F.octet_length("payload") >= least).select("digest", "page_id")
    shared = large.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    shared = shared.where((F.col("rows") > 1) & F.col("first_id").isNotNull()).select("digest", "first_id")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def _record_text(date: str) -> Column:
    """A whole record but for the gap behind it, as text."""
    size = F.octet_length("payload").cast("string")
    revisit = F.col("refers_to").isNotNull()
    named = lambda c: F.concat(F.lit(ID_PREFIX), c.cast("string"), F.lit(ID_SUFFIX))
    # control characters and spaces would break the header
    uri = F.col("url")
    for code in (*range(33), 127):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(GAP)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.coalesce(line("WARC-Record-ID", named(F.col("page_id"))), F.lit("")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(line("WARC-Refers-To", named(F.col("refers_to"))), F.lit("")),
        F.when(revisit, f"WARC-Profile: {PROFILE}\r\n").otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    ), block


def write_archives(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``records`` as WARC files in ``folder``, each compressed as one gzip stream."""
    text, block = _record_text(date)
    written = records.withColumn("block", block).select(text.alias("value"))
    written.write.option("compression", "gzip").option("lineSep", GAP).text(folder)


# --- streams of records --------------------------------------------------------------


@dataclass
class Header:
    """The headers of a record, their own bytes, and the bytes of the block they announce."""

    raw: bytes
    values: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(raw: bytes) -> Header:
        lines = raw.decode("utf-8", errors="replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:80]!r}")
        named = (line.split(":", 1) for line in lines[1:] if ":" in line)
        return Header(raw, {name.strip().lower(): value.strip() for name, value in named})

    @property
    def length(self) -> int:
        return int(self.values["content-length"])


class Inflated:
    """The content of a gzip file, of one member or many, read in pieces."""

    def __init__(self, source, piece: int = PIECE):
        self.source, self.piece = source, piece
        self.inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        self.held, self.at = b"", 0  # what is inflated, and how far it is read
        self.inside = False  # a member has begun and not ended

    def _more(self) -> bool:
        """Inflate another piece of at most ``piece`` bytes; False at the end of the file."""
        while True:
            if self.inflate.eof:  # zeros behind a member are padding
                data = self.inflate.unused_data.lstrip(b"\0")
                while not data and (read := self.source.read(self.piece)):
                    data = read.lstrip(b"\0")
                if not data:
                    return False
                self.inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
            else:
                data = self.inflate.unconsumed_tail or self.source.read(self.piece)
                if not data:
                    if self.inside:
                        raise EOFError("the stream ends inside a member")
                    return False
            out = self.inflate.decompress(data, self.piece)
            self.inside = not self.inflate.eof
            if out:
                self.held, self.at = self.held[self.at :] + out, 0
                return True

    def until(self, mark: bytes, most: int = MOST_HEADER) -> bytes | None:
        """The bytes before ``mark``, which is passed over; None at the end."""
        while (end := self.held.find(mark, self.at)) < 0:
            if len(self.held) - self.at > most:
                raise ValueError("a header without an end")
            if not self._more():
                if self.held[self.at :].strip():
                    raise EOFError("the stream ends inside a header")
                return None
        found, self.at = self.held[self.at : end], end + len(mark)
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if self.at == len(self.held) and not self._more():
                raise EOFError("the stream ends inside a record")
            part = self.held[self.at : self.at + size]
            self.at += len(part)
            size -= len(part)
            yield part


def records_of(stream: Inflated) -> Iterator[tuple[Header, Iterator[bytes]]]:
    """Each record's header and the pieces of its block, which must be read before the next."""
    gap = GAP.encode()
    while (raw := stream.until(gap)) is not None:
        header = Header.of(raw.lstrip(b"\r\n"))
        yield header, stream.take(header.length)
        if b"".join(stream.take(len(gap))) != gap:
            raise ValueError("a record without its end")


# --- one member per record -------------------------------------------------------------


def _member(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """A gzip member of the pieces; its header holds no time, so equal records give equal bytes."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, zlib.MAX_WBITS | 16)
    for piece in pieces:
        yield deflate.compress(piece)
    yield deflate.flush()


def _parts(header: Header, block: Iterator[bytes]) -> Iterator[bytes]:
    yield header.raw + GAP.encode()
    yield from block
    yield GAP.encode()


def _normalise_file(uri: str, folder: str) -> Iterator[tuple[str, int, int, str, str]]:
    """Rewrite one archive into ``folder``; gives (file, offset, length, record id, type)."""
    store, path = fs.FileSystem.from_uri(uri)
    target_store, target = fs.FileSystem.from_uri(folder)
    name = posixpath.basename(path).removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
    final, own = f"{target}/{name}", f"{target}/_{uuid.uuid4().hex}"
    entries = []
    with store.open_input_stream(path, compression=None) as source, target_store.open_output_stream(own, compression=None) as out:
        at = 0
        for header, block in records_of(Inflated(source)):
            size = 0
            for piece in _member(_parts(header, block)):
                out.write(piece)
                size += len(piece)
            entries.append((name, at, size, header.values.get("warc-record-id"), header.values.get("warc-type")))
            at += size
            if len(entries) >= ENTRIES_PER_TASK:
                yield from entries
                entries = []
    target_store.move(own, final)
    yield from entries


INDEX = "file string, offset long, length long, record_id string, record_type string"


def normalise(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Rewrite the gzip WARC files named in ``files`` (``path``, distinct file names) into
    ``folder``, one member per record, and write and return their index: ``file, offset,
    length, record_id, record_type``, stored under ``folder``/_index."""
    names = ["file", "offset", "length", "record_id", "record_type"]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                entries = []
                for entry in _normalise_file(uri, folder):
                    entries.append(entry)
                    if len(entries) >= ENTRIES_PER_TASK:
                        yield _columns(entries, names, kinds)
                        entries = []
                yield _columns(entries, names, kinds)

    _make_folder(folder)
    index = files.select("path").mapInArrow(tidy(rewrite), INDEX)
    index.write.parquet(f"{folder}/_index")
    return spark.read.schema(INDEX).parquet(f"{folder}/_index")


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _make_folder(uri: str) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of every file in ``folder``, one to a task; contents are not read."""
    found = spark.read.format("binaryFile").load(folder).select("path")
    return found.repartitionByRange(max(1, found.count()), "path")


# --- reading by offset -----------------------------------------------------------------

RECORD = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, target_uri string"


def _page_of(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix(ID_PREFIX).removesuffix(ID_SUFFIX))


def _read_member(data: bytes) -> tuple:
    """The values of a record, from the whole of its member."""
    stream = Inflated(pa.BufferReader(data))
    header, block = next(records_of(stream))
    http = b"".join(block)
    head, _, payload = http.partition(GAP.encode())
    values = header.values
    digest = values["warc-payload-digest"].removeprefix("sha1:")
    if values["warc-type"] == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {values.get('warc-record-id')} does not match its digest")
    else:
        lines = (line.split(":", 1) for line in head.decode("utf-8").split("\r\n")[1:])
        size = int({k.lower(): v for k, v in lines}["content-length"])
    return (
        _page_of(values.get("warc-record-id")),
        values["warc-type"],
        size,
        digest,
        _page_of(values.get("warc-refers-to")),
        values.get("warc-target-uri"),
    )


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, each read from its offset: ``page_id, record_type,
    payload_bytes, payload_digest, refers_to, target_uri``. Payloads of responses are checked
    against their digests."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{root}/{file}")
                source.seek(offset)
                rows.append(_read_member(source.read(length)))
            yield _columns(rows, names, kinds)
        if source is not None:
            source.close()

    # runs of neighbouring entries, whatever archive they lie in
    tasks = max(1, -(-index.count() // ENTRIES_PER_TASK))
    dealt = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(tidy(read), RECORD)


def archived(pages: DataFrame, least: int = 0, **columns: str) -> DataFrame:
    """The pages through an archive and back: written, normalised, and read by offset."""
    spark = pages.sparkSession
    folder = new_folder(spark)
    if "://" not in folder:
        folder = f"file://{folder}"
    write_archives(page_records(pages, least, **columns), f"{folder}/whole")
    index = normalise(spark, archive_files(spark, f"{folder}/whole"), f"{folder}/records")
    return read_records(index, f"{folder}/records")


def archived_sql(least: int = 0) -> str:
    """The same digest columns in a second engine."""
    letters = []
    for group in range(8):
        bits = f"CAST('0x' || substr(h, {5 * group + 1}, 5) AS INTEGER)"
        letters += [f"substr('{BASE32}', (({bits} >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)]
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages)
, q AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h FROM p)
, g AS (SELECT *, CASE WHEN payload_bytes >= {least} THEN max(page_id) OVER (PARTITION BY h) END AS first_id FROM q)
SELECT page_id, payload_bytes, {' || '.join(letters)} AS payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g"""
