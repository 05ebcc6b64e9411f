import gzip
import hashlib
import io
import os

import pytest

from ludex.llm import warc
from ludex.session import shared_path

BIG = "<html>" + "é" * 600 + "</html>"
ROWS = [(1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, None, BIG), (2, "http://a/2", "small"),
        (4, "http://a/4", "small"), (6, "http://a/6", None), (7, "http://a/x y\nz", ""),
        (None, "http://n", BIG), (8, "http://a/8", BIG + "!"), (9, "http://a/9", "r" * 2000),
        (9, "http://a/9", "r" * 2000), (10, "http://a/10", "a\r\n\r\nWARC/1.1\r\n\r\n" * 80)]


def brute(rows):
    pay = [(html or "").encode() for _, _, html in rows]
    out = []
    for (page_id, _, _), p in zip(rows, pay, strict=True):
        top = max((i for (i, _, _), q in zip(rows, pay, strict=True)
                   if q == p and i is not None), default=None)
        again = len(p) >= 1000 and top is not None and page_id != top
        out.append((page_id, len(p), hashlib.sha1(p).hexdigest(),
                    "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows],
                                 "page_id bigint, url string, html string, digest string")


def test_round_trip(spark, tmp_path):
    pages(spark, ROWS).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in warc.op6_warc(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(ROWS)


def test_empty(spark, tmp_path):
    pages(spark, []).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op6_warc(spark, str(tmp_path)).count() == 0


def test_nested_rows(spark):
    path = shared_path(spark, "warc-test")
    warc.write_captures(pages(spark, ROWS), path)
    rows = warc.read_captures(spark, path).collect()
    assert sum(r["copies"] for r in rows) == len(ROWS)
    for r in rows:
        assert r["request"]["head"].startswith("GET ") and "fetched-by" in r["metadata"]["head"]
        main = r["response"]
        if main["kind"] == "response":
            assert hashlib.sha1(main["payload"]).hexdigest() == main["payload_digest"]
            assert main["declared_digest"] == "sha1:" + main["payload_digest"]
        else:
            assert main["payload"] is None and main["refers_to"].startswith("<urn:")


def test_records_in_any_order_and_file(spark, tmp_path):
    def record(kind, ident, to, block):
        head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + ident,
                b"Content-Length: %d" % len(block)] + ([b"WARC-Concurrent-To: " + to] if to else [])
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"

    info = record(b"warcinfo", b"<i>", None, b"software: x\r\n")
    with open(f"{tmp_path}/a.warc", "wb") as f:
        f.write(info + record(b"metadata", b"<m>", b"<r>", b"k: v\r\n"))
    with gzip.open(f"{tmp_path}/b.warc.gz", "wb") as f:
        f.write(record(b"response", b"<r>", None, b"HTTP/1.1 200 OK\r\n\r\nbody"))
    with open(f"{tmp_path}/b.warc.gz", "ab") as f:  # one gzip member a record
        f.write(gzip.compress(record(b"request", b"<q>", b"<r>", b"GET / HTTP/1.1\r\n\r\n")))
        f.write(gzip.compress(record(b"request", b"<o>", b"<gone>", b"GET /o HTTP/1.1\r\n\r\n")))
    rows = {r["capture"]: r for r in warc.read_captures(spark, str(tmp_path)).collect()}
    assert bytes(rows["<r>"]["response"]["payload"]) == b"body"
    assert rows["<r>"]["metadata"]["head"] == "k: v\r\n" and rows["<r>"]["copies"] == 1
    assert rows["<gone>"]["response"] is None and rows["<gone>"]["copies"] == 0


def test_cut_archive():
    stream = io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")
    with pytest.raises(ValueError):
        list(warc.parse_records(stream))
    assert os.sep
