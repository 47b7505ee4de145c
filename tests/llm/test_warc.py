"""WARC round trip against a brute-force reading of the pages."""

import base64
import gzip
import hashlib
import tempfile

from playmart.llm import warc
from playmart.llm.queries import op10_warc_transactions

from .conftest import SF

PAGES = [
    (5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, "http://a/3", "same"), (1, "u r\r\nl", "a\r\n\r\nWARC/1.1\r\nb"),
    (2, None, None), (4, "x", ""), (6, "x://é/ü", "é\x00😀" * 4000), (7, "d", "rep"), (7, "d", "rep"), (8, "d", "other"), (8, "e", "other2"),
    (None, "n", "same"), (None, "n", "only"),
]


def expected(rows):
    """Rows in order of page_id; the first of equal payloads is the response."""
    heads, out = {}, []
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = heads.setdefault(digest, (page_id, len(out)))
        revisit = first[1] != len(out)
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first[0] if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")


def test_round_trip(spark, monkeypatch):
    from playmart.llm import queries

    monkeypatch.setattr(queries, "table", lambda s, d, n: frame(s, PAGES).repartition(4))
    got = queries.op10_warc_transactions(spark, "")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == expected(PAGES)


def test_payloads_and_transactions(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write_archives(frame(spark, PAGES), path)
    rows = warc.assemble(warc.read_archives(spark, path)).collect()
    assert len(rows) == len(PAGES)
    bodies = sorted(bytes(r.capture.payload) for r in rows if r.capture.record_type == "response")
    assert bodies == sorted({(h or "").encode() for _, _, h in PAGES})
    for r in rows:
        assert len(r.request) == 1 and len(r.metadata) == 1
        assert (r.capture.payload is None) == (r.capture.record_type == "revisit") == (r.capture.refers_to is not None)


def test_minimum_size_and_empty(spark):
    path = tempfile.mkdtemp(prefix="run-")
    warc.write_archives(frame(spark, PAGES), path + "/a", revisit_from=5)
    kinds = [r.record_type for r in warc.read_archives(spark, path + "/a").collect()]
    assert kinds.count("revisit") == 0 and kinds.count("response") == len(PAGES)
    warc.write_archives(frame(spark, []), path + "/b")
    assert warc.assemble(warc.read_archives(spark, path + "/b")).count() == 0


def test_parse_forms():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    one = b"WARC/1.0\r\nWARC-Type: response\r\nX: a\r\n b\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
        len(block),
        block,
    )
    assert [r["payload"] for r in warc.parse(one + one)] == [b"body", b"body"]
    assert [r["payload"] for r in warc.parse(gzip.compress(one) + gzip.compress(one))] == [b"body", b"body"]
    assert list(warc.parse(b"")) == []


def test_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = sorted((tuple(r[c] for c in names) for r in op10_warc_transactions(spark, SF).collect()), key=str)
    assert got == expected(pages)


def test_urls_plant_no_fields(spark):
    """Line separators other than CRLF do not end a metadata field."""
    import json

    urls = ["http://a.com/\u2028page-id: 99", "http://a.com/\x85page-id: 98", "http://a.com/\x0bpage-id: 97", "http://a.com/\r\npage-id: 96"]
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write_archives(frame(spark, [(i, u, f"body {i}") for i, u in enumerate(urls)]), path)
    rows = warc.assemble(warc.read_archives(spark, path)).collect()
    fields = [r.metadata[0].fields for r in rows]
    assert sorted(f["page-id"] for f in fields) == ["0", "1", "2", "3"]
    assert {json.loads(f["page"])["url"] for f in fields} == set(urls)
    assert all(set(f) == {"page-id", "page"} for f in fields)
