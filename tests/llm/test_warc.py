import base64
import gzip
import hashlib
import io
import pathlib

import pytest

from riskloom.llm import warc

PAGES = "page_id long, url string, html string, digest string"


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) by plain loops."""
    data = [(p, (h or "").encode()) for p, _, h, *_ in rows]
    out = []
    for page, payload in data:
        same = [p for p, other in data if other == payload and p is not None] if len(payload) >= least else []
        first = max(same, default=None)
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.fixture(scope="module")
def pages():
    rows = [(k, f"http://a.example/{k}?q=a b\r\nx: y", f"<p>{k % 7}</p>\r\n\r\nWARC/1.1\r\n\r\n", "d") for k in range(60)]
    rows += [(100, None, None, None), (101, "http://b", "", None), (102, "", "é\U0001f600\0\x1f\x8b", None)]
    rows += [(103, "u", "z" * 700_000, None), (104, "u", "z" * 700_000, None), (None, "u", "<p>1</p>", None)]
    rows += [(105, "one", "twice", None), (105, "two", "twice", None), (None, "u", "twice", None), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("least", [0, 1_000])
def test_pages_return_from_the_archive(spark, pages, least):
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    out = warc.archived(df, least).cache()
    assert found(out) == brute(pages, least)
    uris = {r["page_id"]: r["target_uri"] for r in out.collect()}
    assert uris[0] == "http://a.example/0?q=a%20b%0D%0Ax:%20y" and uris[100] is None
    assert warc.archived(df.limit(0)).count() == 0


def test_every_record_is_a_member(spark, pages, tmp_path):
    df = spark.createDataFrame(pages, PAGES).coalesce(1)
    warc.write_archives(warc.page_records(df), f"file://{tmp_path}/whole")
    files = warc.archive_files(spark, f"file://{tmp_path}/whole")
    index = warc.normalise(spark, files, f"file://{tmp_path}/records").orderBy("file", "offset").collect()
    assert len(index) == len(pages)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(pathlib.Path(f"{tmp_path}/whole").glob("*.gz")))
    again = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(pathlib.Path(f"{tmp_path}/records").glob("*.gz")))
    assert whole == again
    for entry in index:
        data = pathlib.Path(f"{tmp_path}/records/{entry['file']}").read_bytes()
        member = gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]])
        assert member.startswith(b"WARC/1.1\r\nWARC-Type: " + entry["record_type"].encode())
        assert member.endswith(b"\r\n\r\n")
    # a normalised archive normalises to the same bytes
    once = warc.archive_files(spark, f"file://{tmp_path}/records/*.warc.gz")
    warc.normalise(spark, once, f"file://{tmp_path}/twice")
    first, second = (sorted(pathlib.Path(f"{tmp_path}/{d}").glob("*.gz")) for d in ("records", "twice"))
    assert [p.read_bytes() for p in first] == [p.read_bytes() for p in second]


def record(n, body):
    return b"WARC/1.0\r\nContent-Length: %d\r\nN: %d\r\n\r\n" % (len(body), n) + body + b"\r\n\r\n"


@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
def test_streams_of_members_padding_and_cuts(piece):
    bodies = [b"", b"x" * 5_000, b"\r\n\r\nWARC/1.0", bytes(range(256))]
    parts = [record(k, b) for k, b in enumerate(bodies)]
    joined = b"".join(parts)
    cuts = [gzip.compress(joined), b"".join(map(gzip.compress, parts)), b"\0\0".join(map(gzip.compress, parts)) + b"\0" * 9]
    cuts.append(gzip.compress(joined[:100]) + gzip.compress(b"") + gzip.compress(joined[100:]))  # members cut records
    for data in cuts:
        read = [(h.values["n"], b"".join(b)) for h, b in warc.records_of(warc.Inflated(io.BytesIO(data), piece))]
        assert read == [(str(k), b) for k, b in enumerate(bodies)]
    assert not list(warc.records_of(warc.Inflated(io.BytesIO(gzip.compress(b"")), piece)))
    assert not list(warc.records_of(warc.Inflated(io.BytesIO(b""), piece)))
    for broken in (cuts[0][:-20], gzip.compress(joined[:-3]), gzip.compress(b"HTTP/1.1\r\n\r\n")):
        with pytest.raises((EOFError, ValueError)):
            for _, block in warc.records_of(warc.Inflated(io.BytesIO(broken), piece)):
                b"".join(block)
