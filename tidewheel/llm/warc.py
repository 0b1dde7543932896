"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is written as three records (request; response or revisit; metadata), tied by
WARC-Concurrent-To. Of captures with equal payloads only one holds the payload, the others are
revisit records that refer to it. Archives are written by Spark's own text writer (its separator
is the CRLF CRLF after each record), so they reach any store that Spark can write and a lost
executor's files are written again; a new archive begins every ARCHIVE_BYTES, so that readers,
which take an archive at a time, need bounded memory. Equal payloads are found by shuffling keys and
digests, and only payloads of which there are several move. Assembly joins by record ids, which only
repeated rows (of one key and payload, that others refer to) share, so no other key is hot.

Readers take any archive: headers of any bytes, chunked bodies; what can't be read is a row of type
rejected instead of an error, as one broken record of a crawl mustn't stop a job. An archive is one row
(Spark's reader of binary files gives it whole, so an executor must hold the largest one).
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.shared import looked_up, ship, sieve, written

ARCHIVE_BYTES = 32_000_000
#: Bytes of payload that a reader hands over at a time.
BATCH_BYTES = 8_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_URL = "urn:x-no-url"
END = "\r\n\r\n"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """RFC 4648 base 32 of 40 hexadecimal digits: five of these are four of the others."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _named(*parts: Column) -> Column:
    """A record id made from parts."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind: str | Column, headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), kind if isinstance(kind, Column) else F.lit(kind)]
    for name, value in headers:
        value = value if isinstance(value, Column) else F.lit(value)
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))
    return F.concat(*lines, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2020-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """The records of all rows of pages, as column value (without the CRLF CRLF that ends them).

    Of rows with equal payloads of at least `least` bytes those with the largest key are responses,
    all others revisit that one (a null key is the smallest; if all are null, all are responses).
    A null payload is empty, a null url is written as NO_URL, line breaks in a url are percent-encoded.
    Other columns are left out.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    same = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("key").alias("target"), F.count("*").alias("n")).filter("n > 1")
    same = written(same)  # keys and digests only
    # payloads of which there is one stay where they are, and so do very common ones
    repeated = sieve(same, "digest")(F.col("digest"))
    once = rows.filter(~repeated).withColumn("target", F.lit(None).cast(rows.schema["key"].dataType))
    rows = once.unionByName(looked_up(rows.filter(repeated), same.select("digest", "target"), ["digest"], same.select("digest", "n")))
    revisit = F.col("target").isNotNull() & ~F.col("key").eqNullSafe(F.col("target"))
    # only a record that others refer to needs an id that they can derive
    derived = _named(F.lit("target"), F.col("target").cast("string"), F.col("digest"))
    own = F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))
    rows = rows.withColumns({
        "revisit": revisit,
        "id": F.when(F.col("target").isNotNull() & ~revisit, derived).otherwise(own),
        "refers": F.when(revisit, derived),
        "uri": F.coalesce(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(NO_URL)),
        "size": F.octet_length("payload"),
    })
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    stamp = F.lit(date)
    more = [("WARC-Date", stamp), ("WARC-Concurrent-To", F.col("id")), ("WARC-Target-URI", F.col("uri"))]
    new_id = lambda: F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))
    request = _record("request", [("WARC-Record-ID", new_id()), *more, ("Content-Type", "application/http; msgtype=request")], F.concat(F.lit("GET "), F.col("uri"), F.lit(" HTTP/1.1" + END)))
    main = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        [("WARC-Record-ID", F.col("id")), ("WARC-Date", stamp), ("WARC-Target-URI", F.col("uri")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))), ("WARC-Refers-To", F.col("refers")), ("WARC-Profile", F.when(F.col("revisit"), PROFILE)), ("Content-Type", "application/http; msgtype=response")],
        F.when(F.col("revisit"), head).otherwise(F.concat(head, F.col("payload"))),
    )
    fields = F.concat(F.lit("payload-length: "), F.col("size").cast("string"), F.coalesce(F.concat(F.lit("\r\nkey: "), F.col("key").cast("string")), F.lit("")))
    metadata = _record("metadata", [("WARC-Record-ID", new_id()), *more, ("Content-Type", "application/warc-fields")], fields)
    return rows.select(F.explode(F.array(request, main, metadata)).alias("value"))


def write(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes records (column value) as gzipped archives of about archive_bytes each, in folders archive=N."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 24, 0
        for b in batches:
            sizes = pc.cast(pc.binary_length(b.column(0)), pa.int64())
            ends = pc.add(pc.cumulative_sum(sizes), pa.scalar(done, pa.int64()))
            if len(b):
                done = ends[-1].as_py()
            at = pc.add(pc.divide(pc.subtract(ends, sizes), archive_bytes), first)
            yield pa.RecordBatch.from_arrays([at, b.column(0)], ["archive", "value"])

    rows.select("value").mapInArrow(numbered, "archive bigint, value string").write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)


_RECORD = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
_RECORD_DDL = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, digest string, fields map<string,string>, payload binary"


def _text(raw: bytes) -> str:
    """UTF-8, or else Latin-1, which any bytes are."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _headers(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (_text(x).partition(":") for x in lines) if k}


def unchunked(body: bytes) -> bytes:
    """A body without its chunked transfer coding; as it is if it doesn't follow that coding."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            n = int(body[at:end].partition(b";")[0], 16)
        except ValueError:
            return body
        if n == 0:
            return b"".join(parts)
        if n < 0 or body[end + 2 + n : end + 4 + n] != b"\r\n":
            return body
        parts.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n
    return body


def _rejected(key: str | None, why: str) -> dict:
    return {"record_id": key, "type": "rejected", "concurrent_to": None, "refers_to": None, "target_uri": None, "digest": None, "fields": [("error", why)], "payload": None}


class _Unzipped(io.RawIOBase):
    """What the gzip members of an archive hold, up to where they can't be read; error then says why."""

    def __init__(self, data: bytes):
        self.data, self.at, self.member, self.rest, self.error = data, 0, None, b"", ""

    def readable(self) -> bool:
        return True

    def readinto(self, into: bytearray) -> int:
        while not self.error:
            if self.member is None:
                if self.at >= len(self.data):
                    return 0
                self.member = zlib.decompressobj(31)
            piece = self.rest
            if not piece:
                piece = self.data[self.at : self.at + (1 << 16)]
                self.at += len(piece)
            if not piece:
                self.error = "it ends within a gzip member"
                break
            try:
                out = self.member.decompress(piece, len(into))
            except zlib.error as e:
                self.error = str(e)
                break
            self.rest = self.member.unconsumed_tail
            if self.member.eof:
                self.at -= len(self.member.unused_data)
                self.member, self.rest = None, b""
            if out:
                into[: len(out)] = out
                return len(out)
        return 0


def parse(archive: bytes) -> Iterator[dict]:
    """The records of one archive (gzipped, as a whole or by record, or plain), by their Content-Length alone.

    A record that is cut off, has no length or doesn't begin as one is of type rejected, with the reason as field
    error, and the last of its archive: nothing tells where the next would begin.
    """
    raw = _Unzipped(archive) if archive[:2] == b"\x1f\x8b" else None
    stream = io.BufferedReader(raw) if raw else io.BytesIO(archive)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            yield _rejected(None, f"no WARC record begins with {line[:40]!r}")
            return
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line)
        head = _headers(lines)
        key, length = head.get("warc-record-id"), head.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", length):
            yield _rejected(key, f"its Content-Length is {length!r}")
            return
        block = stream.read(int(length))
        if len(block) < int(length):
            yield _rejected(key, f"{len(block)} of {length} bytes are there")
            return
        kind = head.get("warc-type", "")
        top, _, body = block.partition(b"\r\n\r\n") if kind in ("request", "response", "revisit") else (block, b"", b"")
        fields = _headers(top.split(b"\r\n"))
        if "chunked" in fields.get("transfer-encoding", "").lower():
            body = unchunked(body)
        yield {
            "record_id": key, "type": kind, "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"), "digest": head.get("warc-payload-digest"), "fields": list(fields.items()), "payload": body if kind == "response" else None,
        }
    if raw and raw.error:
        yield _rejected(None, f"its archive can't be decompressed: {raw.error}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below path, in the columns of _RECORD_DDL. payload: of responses, else null;
    fields: those of the HTTP head or of the metadata record."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for r in parse(content.as_py()):
                    rows.append(r)
                    size += 1000 + len(r["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    ship(spark)
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return archives.select("content").mapInArrow(parsed, _RECORD_DDL)


def assemble(rows: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """One nested row per response or revisit: record_id, capture (its columns), request and metadata.

    request and metadata are the records concurrent to it (the first by record id if there are
    several, null if there is none). payload: the columns of rows that capture takes, by default all
    but concurrent_to; leaving the payload out keeps it from being shuffled.
    """
    kept = payload or [c for c in rows.columns if c != "concurrent_to"]

    def beside(kind: str) -> DataFrame:
        own = F.struct("record_id", "target_uri", "fields")
        return rows.filter(F.col("type") == kind).select(F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("_by"), own.alias(kind)).groupBy("record_id").agg(F.min_by(kind, "_by").alias(kind))

    main = rows.filter(F.col("type").isin("response", "revisit")).select("record_id", F.struct(*kept).alias("capture"))
    return main.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")


def captures(rows: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri of what read() returned.

    The target is the one that was asked for: the request's, or the capture's own if there is no request. A response's size and digest are those of the payload read back; a revisit's digest is its
    header's, its size the one in its metadata record, and refers_to the page of the response that
    its WARC-Refers-To names (null if that record isn't there). The archives are parsed once.
    """
    slim = written(rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("own", base32(F.sha1("payload"))).drop("payload"))
    r = assemble(slim, ["type", "digest", "bytes", "own", "refers_to", "target_uri"])
    f = F.col("metadata.fields")
    r = r.select(
        "record_id",
        f["key"].cast("long").alias("page_id"),
        F.coalesce(F.col("capture.bytes"), f["payload-length"].cast("long")).alias("payload_bytes"),
        F.coalesce(F.col("capture.own"), F.substring_index("capture.digest", ":", -1)).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.col("capture.refers_to").alias("to"),
        F.coalesce("request.target_uri", "capture.target_uri").alias("target_uri"),
    )
    # the captures that others refer to, by the ids of their records
    r = written(r)
    named = r.filter("record_type = 'response'").groupBy(F.col("record_id").alias("to")).agg(F.max("page_id").alias("refers_to"))
    return looked_up(r.drop("record_id"), named, ["to"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


#: The same result in DuckDB's SQL.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), 'urn:x-no-url') AS target_uri, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, target_uri, body, h, CAST('0x' || substr(h, 5 * k + 1, 5) AS BIGINT) AS v, k FROM p, range(8) r(k)),
d AS (
  SELECT page_id, target_uri, body, h, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' ORDER BY k) AS digest
  FROM b GROUP BY page_id, target_uri, body, h)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER (PARTITION BY h) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = max(page_id) OVER (PARTITION BY h) THEN NULL ELSE max(page_id) OVER (PARTITION BY h) END AS refers_to, target_uri
FROM d
"""
