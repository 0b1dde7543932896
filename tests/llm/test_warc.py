import base64
import gzip
import hashlib
import os

from pyspark.sql import functions as F

from tidewheel.llm import warc as W
from tidewheel.llm.shared import shared_dir

ROWS = [(1, "http://a/", "<p>same</p>", 1), (2, "http://b/\r\nX: y", "<p>same</p>", 1), (3, None, "", 1), (4, "", None, 1), (5, "http://é/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n", 1), (6, "u", "\r\n\r\n\r\n\r\n", 1),
        (7, "u", "\r\n\r\n\r\n\r\n", 1), (7, "u", "\r\n\r\n\r\n\r\n", 1), (None, "n", "<p>same</p>", 1), (8, "big", "é" * 400_000, 1), (9, "x", "tail\r\n", 1)]


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string, type int")
    path = shared_dir(spark)
    W.write(W.records(df), path, archive_bytes=300_000)
    rows = W.read(spark, path)
    assert rows.groupBy("type").count().rdd.collectAsMap() == {"request": 11, "metadata": 11, "response": 7, "revisit": 4}
    assert rows.select("record_id").distinct().count() == 32  # repeated rows of a response that others refer to share its id
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.captures(rows).collect())
    target = {"<p>same</p>": 2, "": 4, "\r\n\r\n\r\n\r\n": 7}
    want = []
    for k, _, t, _ in ROWS:
        to = target.get(t or "")
        revisit = to is not None and k != to
        want.append((k is None, k or 0, len((t or "").encode()), digest(t), "revisit" if revisit else "response", to if revisit else None))
    assert got == sorted(want)
    whole = {r.record_id: bytes(r.capture.payload) for r in W.assemble(rows).filter("capture.type = 'response'").collect()}
    assert set(whole.values()) == {(t or '').encode() for _, _, t, _ in ROWS}
    nested = W.assemble(rows).filter("request is null or metadata is null").count()
    assert nested == 0


def test_least_and_empty(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string, type int")
    path = shared_dir(spark)
    W.write(W.records(df, least=5), path)
    kinds = {(r.page_id, r.record_type) for r in W.captures(W.read(spark, path)).collect()}
    assert (3, "response") in kinds and (4, "response") in kinds and (1, "revisit") in kinds
    empty = shared_dir(spark)
    W.write(W.records(df.limit(0)), empty)
    assert W.captures(W.read(spark, empty)).count() == 0


def test_foreign_archives(spark):
    """Fields that only this writer's metadata have aren't needed to find what a revisit refers to."""
    record = lambda kind, key, more, block: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{key}>\r\n{more}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\n\r\n"
    data = record("response", "r1", "", http + "body") + record("metadata", "m1", "WARC-Concurrent-To: <r1>\r\n", "key: 5\r\n")
    data += record("revisit", "r2", "WARC-Refers-To: <r1>\r\nWARC-Payload-Digest: sha1:X\r\n", http) + record("metadata", "m2", "WARC-Concurrent-To: <r2>\r\n", "key: 4\r\npayload-length: 4\r\n")
    data += record("revisit", "r3", "WARC-Refers-To: <gone>\r\n", http)
    rows = spark.createDataFrame([r | {"fields": dict(r["fields"])} for r in W.parse(data.encode())], W._RECORD_DDL)
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in W.captures(rows).collect()}
    assert got == {(5, 4, "response", None), (4, 4, "revisit", 5), (None, None, "revisit", None)}


def test_parse_by_length():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 10\r\n\r\nH\r\n\r\n12\r\n\r\r\n\r\n"
    for data in (one + one, gzip.compress(one + one), gzip.compress(one) + gzip.compress(one)):
        assert [r["payload"] for r in W.parse(data)] == [b"12\r\n\r"] * 2
    assert list(W.parse(b"")) == []


def test_base32(spark):
    df = spark.createDataFrame([("a",), ("",), ("é" * 99,)], "t string")
    for r in df.select("t", W.base32(F.sha1(F.col("t").cast("binary"))).alias("d")).collect():
        assert r.d == digest(r.t)


def test_records_that_others_have_written(spark):
    record = lambda block, more=b"": b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\n" + more + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    latin = record(b"HTTP/1.1 200 OK\r\nX-Name: caf\xe9\r\n\r\nbody", b"WARC-Target-URI: http://a/\xe9\r\n")
    (r,) = W.parse(latin)
    assert dict(r["fields"])["x-name"] == "café" and r["target_uri"] == "http://a/é" and r["payload"] == b"body"
    chunks = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    for coded, want in ((b"4\r\nWiki\r\n6;x=y\r\npedia \r\n0\r\n\r\n", b"Wikipedia "), (b"0\r\n\r\n", b""), (b"no chunks", b"no chunks"), (b"9\r\nshort\r\n", b"9\r\nshort\r\n"), (b"-1\r\n\r\n", b"-1\r\n\r\n")):
        (r,) = W.parse(record(chunks + coded))
        assert r["payload"] == want
    whole = record(b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * 40)
    for broken in (whole + whole[:-20], gzip.compress(whole) + gzip.compress(whole)[:-30], whole + b"garbage\r\n", whole + b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", gzip.compress(whole) + b"\x1f\x8b\x08nothing"):
        first, last = W.parse(broken)
        assert first["type"] == "response" and last["type"] == "rejected" and dict(last["fields"])["error"]
    path = shared_dir(spark)
    folder = path.removeprefix("file://")
    os.makedirs(folder)
    for name, data in (("a.warc", latin + whole[:-99]), ("b.warc.gz", gzip.compress(whole)[:-40]), ("c.warc", b"")):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    rows = W.read(spark, path)
    assert {(r.type, r.n) for r in rows.groupBy("type").agg(F.count("*").alias("n")).collect()} == {("response", 1), ("rejected", 2)}
    assert [(r.record_type, r.payload_bytes) for r in W.captures(rows).collect()] == [("response", 4)]


def test_the_request_says_what_was_asked_for(spark):
    record = lambda kind, key, more, block: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{key}>\r\n{more}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\n\r\n"
    data = record("request", "q1", "WARC-Concurrent-To: <r1>\r\nWARC-Target-URI: http://asked/\r\n", "GET / HTTP/1.1\r\n\r\n") + record("response", "r1", "WARC-Target-URI: http://came/\r\n", http) + record("response", "r2", "WARC-Target-URI: http://alone/\r\n", http)
    rows = spark.createDataFrame([r | {"fields": dict(r["fields"])} for r in W.parse(data.encode())], W._RECORD_DDL)
    assert {r.target_uri for r in W.captures(rows).collect()} == {"http://asked/", "http://alone/"}
