"""WARC archives: writing, reading and transaction assembly.

``write_archives`` turns each page into three records: the request, the
capture (``response``, or ``revisit`` when an earlier record holds the same
payload) and a metadata record; request and metadata name the capture in
WARC-Concurrent-To. Records are written by Spark's text writer as gzip files
of a bounded number of records, so a task's file appears only when the task
commits and a lost executor leaves no half archive behind.

``read_archives`` parses archives (plain or gzip, one or many members) by
their Content-Length; a file is read whole by one task, which is why the
writer bounds the file size. ``assemble`` joins the records of a transaction
through their concurrent-to identifiers into one nested row per capture.

Of the rows whose payloads are equal and have at least ``revisit_from``
bytes, the one with the smallest page_id is the response and the others
revisit it; shorter payloads are always responses. A repeated page row is a
capture of its own: the first of equal rows with the smallest page_id is the
response. Null html is the empty payload, a null URL an empty target; a row
without a page_id never becomes the response of rows that have one. Extra
columns are ignored and an empty table writes no records.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CRLF = "\r\n"
# Pages per archive file: bounds what one reading task holds.
PAGES_PER_FILE = 1_000
# Bytes of payload after which the parser hands a batch on.
BATCH_BYTES = 16 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF

RECORDS = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, fields map<string,string>, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text's UTF-8 bytes."""
    digits = F.sha1(data.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_uri(kind: str, key: Column, digest: Column, copy: Column) -> Column:
    """<urn:uuid:...> derived from what the record holds."""
    h = F.md5(F.concat_ws("|", F.lit(kind), key, digest, copy.cast("string")).cast("binary"))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """One record without the closing CRLF CRLF, which the writer adds."""
    lines: list[Column] = [F.lit("WARC/1.1" + CRLF)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit("")))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), block)


def captures(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Pages with payload digest, copy number and the page they revisit."""
    body = pages.select(
        F.col("page_id").cast("long"),
        "url",
        F.coalesce("html", F.lit("")).alias("body"),
    ).select(
        "*",
        base32_sha1(F.col("body")).alias("digest"),
        F.octet_length("body").alias("size"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key"),
    )
    small = body.select("page_id", "key", "digest", "size")
    heads = (
        small.where(F.col("size") >= revisit_from)
        .groupBy("digest", "size")
        .agg(F.min("page_id").alias("head"), F.count("*").alias("n"))
        .where("n > 1 and head is not null")
        .drop("n")
    )
    of_page = small.join(heads, ["digest", "size"]).select("key", "digest", "head").distinct()
    copy = F.row_number().over(Window.partitionBy("key", "digest").orderBy("url"))
    return (
        body.withColumn("copy", copy)
        .join(of_page, ["key", "digest"], "left")
        .withColumn("is_revisit", F.expr("head is not null and not (page_id <=> head and copy = 1)"))
    )


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Three records per page as gzip archives under ``path``."""
    key, digest, copy = F.col("key"), F.col("digest"), F.col("copy")
    capture = record_uri("capture", key, digest, copy)
    head = record_uri("capture", F.col("head").cast("string"), digest, F.lit(1))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(
        F.lit(HTTP_HEAD + "Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF)
    )
    rest = F.regexp_extract(target, "://([^/?#]*)", 1)

    def common_headers(kind: str, uri: Column) -> list[tuple[str, Column | str]]:
        return [("WARC-Type", kind), ("WARC-Record-ID", uri), ("WARC-Date", date), ("WARC-Target-URI", target)]

    request = record(
        [
            *common_headers("request", record_uri("request", key, digest, copy)),
            ("WARC-Concurrent-To", capture),
            ("Content-Type", "application/http;msgtype=request"),
        ],
        F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1" + CRLF + "Host: "), rest, F.lit(CRLF + CRLF)),
    )
    digest_header = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest))
    kind = ("Content-Type", "application/http;msgtype=response")
    response = record([*common_headers("response", capture), digest_header, kind], F.concat(http, F.col("body")))
    revisit = record(
        [
            *common_headers("revisit", capture),
            digest_header,
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", head),
            kind,
        ],
        http,
    )
    about = F.concat(F.lit("page-id: "), key, F.lit(CRLF + "page: "), F.to_json(F.struct("url")), F.lit(CRLF))
    metadata = record(
        [
            *common_headers("metadata", record_uri("metadata", key, digest, copy)),
            ("WARC-Concurrent-To", capture),
            ("Content-Type", "application/warc-fields"),
        ],
        about,
    )
    rows = captures(pages, revisit_from).select(
        F.explode(F.array(request, F.when(F.col("is_revisit"), revisit).otherwise(response), metadata)).alias("value")
    )
    (
        rows.write.option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * PAGES_PER_FILE)
        .text(path)
    )


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive, in order."""
    import base64
    import gzip
    import hashlib
    import io

    raw = io.BytesIO(data)
    source = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if data[:2] == b"\x1f\x8b" else raw
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := source.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and name:  # a folded header line
                headers[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
        size = int(headers.get("content-length", "0"))
        block = source.read(size)
        if len(block) != size:
            raise ValueError(f"truncated record {headers.get('warc-record-id')}")
        kind = headers.get("warc-type", "")
        fields, payload = None, block
        if headers.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            # CRLF alone ends a field: a URL may hold other line separators
            lines = block.decode("utf-8", "replace").split(CRLF)
            fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines) if k]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            digest, payload = stated, None
        elif stated and kind == "response" and stated != digest:
            raise ValueError(f"payload digest differs in {headers.get('warc-record-id')}")
        yield {
            "record_id": headers.get("warc-record-id"),
            "record_type": kind,
            "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"),
            "target_uri": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"),
            "payload_digest": digest,
            "payload_bytes": None if payload is None else len(payload),
            "fields": fields,
            "payload": payload,
        }


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under a path; without ``payload``, digests and sizes only."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        text = pa.string()
        kinds = {"payload_bytes": pa.int64(), "fields": pa.map_(text, text), "payload": pa.binary()}
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, text)) for c in names], names)

        rows, held = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for row in parse(content.as_py()):
                    held += row["payload_bytes"] or 0
                    rows.append(row if payload else row | {"payload": None})
                    if held >= BATCH_BYTES or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its own fields, its request records and
    its metadata records, linked by concurrent-to identifiers in either
    direction. A capture without them has empty arrays."""
    is_capture = F.col("record_type").isin("response", "revisit")
    found = records.where(is_capture)

    def linked(kind: str) -> DataFrame:
        others = records.where(F.col("record_type") == kind)
        row = F.struct("record_id", "target_uri", "date", "fields", "payload")
        named = others.where("concurrent_to is not null").select(F.col("concurrent_to").alias("capture_id"), row.alias(kind))
        back = (
            found.where("concurrent_to is not null")
            .select(F.col("record_id").alias("capture_id"), F.col("concurrent_to").alias("other_id"))
            .join(others.select(F.col("record_id").alias("other_id"), row.alias(kind)), "other_id")
            .select("capture_id", kind)
        )
        return named.unionByName(back).groupBy("capture_id").agg(F.collect_list(kind).alias(kind))

    out = found.withColumnRenamed("record_id", "capture_id")
    for kind in ("request", "metadata"):
        out = out.join(linked(kind), "capture_id", "left").withColumn(kind, F.coalesce(kind, F.array()))
    return out.select(
        F.col("capture_id"),
        F.struct(
            "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "payload"
        ).alias("capture"),
        "request",
        "metadata",
    )
