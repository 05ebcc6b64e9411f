"""WARC archives: writing captures, and assembling transactions on reading.

A capture is written as three records: the request, the response (or a revisit
of an earlier identical payload, without the payload) and metadata; request
and metadata name the response in ``WARC-Concurrent-To``. On reading, records
of any order and file are joined through these identifiers to one nested row
per capture.

Archives go through Spark's text writer (record by record, CRLF CRLF after
each, gzip), so they reach any file system Spark can write and only files of
committed tasks appear; they are read as binary files and parsed by record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludex.llm.common import read_table
from ludex.session import shared_path, stage_table

MIN_REVISIT_BYTES = 1000
# Records of one archive file at most (three per capture).
RECORDS_PER_FILE = 12_000
CAPTURE_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _urn(kind: str, page_id: Column, url: Column, digest: Column) -> Column:
    return F.concat(F.lit(f"<urn:ludex:{kind}:"), F.coalesce(page_id.cast("string"), F.lit("none")),
                    F.lit(":"), F.md5(F.coalesce(url, F.lit(""))), F.lit(":"), digest, F.lit(">"))


def _record(kind: Column | str, record_id: Column, uri: Column, content_type: str,
            more: list[Column], block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind),
            F.concat(F.lit("WARC-Record-ID: "), record_id),
            F.lit(f"WARC-Date: {CAPTURE_DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), uri), *more,
            F.lit(f"Content-Type: {content_type}"),
            F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *head), F.lit(END), block)  # NULL lines fall away


def write_captures(pages: DataFrame, path: str,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives under ``path``.

    Of captures with equal payloads of at least ``min_revisit_bytes`` that of
    the largest page_id is the response, the others revisit it (rows that
    share that page_id all are responses; a NULL page_id counts as lower than
    any). NULL html is an empty payload; a NULL url has no target URI; white
    space and control characters of a url are written as %20."""
    rows = pages.select("page_id", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn(
        "large", F.octet_length("html") >= min_revisit_bytes)
    # Only digests that occur twice or more need a decision.
    keepers = (rows.where("large").groupBy("digest")
               .agg(F.max(F.struct("page_id", "url")).alias("keeper"),
                    F.count(F.lit(1)).alias("n")).where("n > 1 and keeper.page_id is not null")
               .select(F.col("digest").alias("same"), "keeper"))
    rows = rows.join(keepers, (F.col("digest") == F.col("same")) & F.col("large"), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("keeper.page_id"))
                         & F.col("keeper").isNotNull(), F.lit(False))
    main = _urn("response", F.col("page_id"), F.col("url"), F.col("digest"))
    other = F.when(F.col("revisit"), _urn("response", F.col("keeper.page_id"),
                                          F.col("keeper.url"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), main, F.col("url"),
        "application/http;msgtype=response",
        [F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
         F.when(F.col("revisit"), F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
         F.concat(F.lit("WARC-Refers-To: "), other)],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))))
    joined = [F.concat(F.lit("WARC-Concurrent-To: "), main)]
    ident = (F.col("page_id"), F.col("url"), F.col("digest"))
    request = _record(
        "request", _urn("request", *ident), F.col("url"), "application/http;msgtype=request",
        joined, F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")),
                         F.lit(f" HTTP/1.1\r\nAccept: text/html{END}")))
    metadata = _record(
        "metadata", _urn("metadata", *ident), F.col("url"), "application/warc-fields", joined,
        F.concat(F.concat_ws("\r\n", F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                             F.lit("fetched-by: ludex")), F.lit("\r\n")))
    (rows.withColumn("revisit", revisit)
     .select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an open archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut off")
        yield headers, block


def _http(block: bytes) -> tuple[str, bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return head.decode("utf-8", "replace"), body


_RECORD = pa.schema([
    ("capture", pa.string()), ("kind", pa.string()), ("target_uri", pa.string()),
    ("date", pa.string()), ("refers_to", pa.string()), ("declared_digest", pa.string()),
    ("head", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary())])
_RECORD_SQL = ("capture string, kind string, target_uri string, date string, refers_to string, "
               "declared_digest string, head string, payload_bytes bigint, "
               "payload_digest string, payload binary")


def _parse(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column("content")[i].as_buffer()
                raw = io.BytesIO(content)
                stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
                rows: list[tuple] = []
                held = 0
                for headers, block in parse_records(stream):
                    kind = headers.get("warc-type", "")
                    if kind not in ("request", "response", "revisit", "metadata"):
                        continue  # warcinfo and others belong to no capture
                    head, body = ("", block) if kind == "metadata" else _http(block)
                    if kind == "metadata":
                        head, body = block.decode("utf-8", "replace"), b""
                    main = kind in ("response", "revisit")
                    rows.append((
                        headers["warc-record-id"] if main else headers.get("warc-concurrent-to"),
                        kind, headers.get("warc-target-uri"), headers.get("warc-date"),
                        headers.get("warc-refers-to"), headers.get("warc-payload-digest"), head,
                        len(body) if kind == "response" else None,
                        hashlib.sha1(body).hexdigest() if kind == "response" else None,
                        body if with_payload and kind == "response" else None))
                    held += len(rows[-1][6]) + len(rows[-1][9] or b"")
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD, strict=True)],
        schema=_RECORD)


def read_captures(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The archives under ``path``, one nested row per capture: capture (the
    response's record id), copies (equal response records), response (kind,
    target_uri, date, refers_to, declared_digest, head, payload_bytes,
    payload_digest, payload), request (target_uri, head) and metadata (head).
    A part that no record gives is NULL. One archive file is parsed by one
    task; what is shuffled is parsed records, by capture."""
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(_parse(with_payload), _RECORD_SQL)
    main = F.col("kind").isin("response", "revisit")
    part = lambda cond, *cols: F.max(F.when(cond, F.struct(*cols)))
    return (records.where("capture is not null").groupBy("capture").agg(
        F.count(F.when(main, 1)).alias("copies"),
        part(main, "kind", "target_uri", "date", "refers_to", "declared_digest", "head",
             "payload_bytes", "payload_digest", "payload").alias("response"),
        part(F.col("kind") == "request", "target_uri", "head").alias("request"),
        part(F.col("kind") == "metadata", "head").alias("metadata")))


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Writes every page, reads the archives back, one row per page. Pages
    that are equal in all columns are one capture of several copies."""
    path = shared_path(spark, "warc")
    write_captures(read_table(spark, sf_dir, "pages"), path)
    # NULL page ids have no page-id line.
    number = F.regexp_extract("metadata.head", r"(?m)^page-id: (-?\d+)", 1)
    captures = stage_table(read_captures(spark, path, with_payload=False).select(
        "capture", "copies", F.when(number != "", number.cast("bigint")).alias("page_id"),
        F.col("response.kind").alias("record_type"), F.col("response.refers_to").alias("target"),
        F.col("response.payload_bytes").alias("bytes"),
        F.col("response.payload_digest").alias("digest")), "captures")
    targets = captures.where("record_type = 'response'").select(
        F.col("capture").alias("target"), F.col("page_id").alias("refers_to"),
        F.col("bytes").alias("target_bytes"), F.col("digest").alias("target_digest"))
    out = captures.join(targets, "target", "left")
    return out.select(
        "page_id", F.coalesce("bytes", "target_bytes").alias("payload_bytes"),
        F.coalesce("digest", "target_digest").alias("payload_digest"), "record_type", "refers_to",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


OP6_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS top FROM p WHERE b >= 1000 GROUP BY d)
SELECT page_id, b AS payload_bytes, p.d AS payload_digest,
       CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id = top THEN NULL ELSE top END AS refers_to
FROM p LEFT JOIN k ON p.d = k.d AND b >= 1000
"""
