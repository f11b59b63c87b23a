"""Operator 5: WARC archives, written with revisit records and read back by a
salvage reader.

Writing: the payload digest is computed beside the scan; only digests are
grouped (partial sums first), and the pages that repeat a payload are found by a
join of digests. The pages then take their own entry by (page id, digest) -- no
shuffle puts copies of one payload together, so a payload that a third of all
pages share is no hot key for the page bodies. Every record is a gzip member of
its own; Spark's text sink writes the members as raw bytes, an empty member
(which every reader skips) as line separator, into any file system that Spark
can write, a bounded number of records a file.

Reading: the files come as binary rows. A member or record that fails a check
(gzip check sum, version line, header lines, length, payload digest) is not the
end: the reader searches for the next member magic or version line from which a
valid record can be read, goes on there, and logs the byte gap between as
quarantined, with the reason.

Defined results: null html is an empty payload; payloads of any length are kept
whole; a page without id is always a response; of repeated pages with the
largest id of a group each is a response; header values lose line breaks; other
columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_REVISIT = 1000
RECORDS_PER_FILE = 4000
LEVEL = 3
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 16


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


#: Between two records; as text in Latin-1 it is the line separator of the sink.
EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or 'about:blank')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


# -- writing ---------------------------------------------------------------
def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat a payload of
    ``least`` bytes or more; ``pages`` has page_id, digest and size."""
    large = pages.where(F.col("size") >= least).select("page_id", "digest")
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return large.join(kept, "digest").where("page_id <> refers_to").distinct()


def with_digest(pages: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload")).select("*", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("size"))


def write_warc(pages: DataFrame, path: str, least: int = LEAST_REVISIT, date: str = "2000-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``."""
    all_pages = with_digest(pages)
    repeated = revisits(all_pages.drop("payload"), least).withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    marked = all_pages.join(repeated, (F.col("page_id") == F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    marked = marked.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "digest", "size", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                rows = zip(*[c.to_pylist() for c in b.slice(lo, 256).columns])
                yield pa.RecordBatch.from_arrays([pa.array([gzip_member(warc_record(i, u, p, d, n, r, date)) for i, u, p, d, n, r in rows], pa.binary())], names=["member"])

    members = marked.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_file).text(path)


# -- reading ---------------------------------------------------------------
class Found(NamedTuple):
    """A record, or a quarantined gap (``reason`` says why)."""

    start: int
    end: int
    reason: str | None
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _header_lines(lines: list[bytes]) -> dict[str, str] | None:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return None
        out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes, at: int) -> tuple[Found | None, str, int]:
    """The record that starts at ``at`` (or none, and why not) and its end."""
    if data[at : at + len(VERSION)] != VERSION:
        return None, "no version line", at
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None, "header does not end", at
    headers = _header_lines(data[at:end].split(b"\r\n")[1:])
    if headers is None or not headers.get("content-length", "").isdigit() or not {"warc-type", "warc-record-id"} <= headers.keys():
        return None, "bad header", at
    lo = end + 4
    hi = lo + int(headers["content-length"])
    if data[hi : hi + 4] != b"\r\n\r\n":
        return None, "bad length", at
    block = data[lo:hi]
    http, payload = {}, block
    if block.startswith(b"HTTP/"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _header_lines(head.split(b"\r\n")[1:]) or {}
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha1:") and hashlib.sha1(payload).hexdigest() != digest[5:]:
        return None, "payload digest differs", at
    return Found(at, hi + 4, None, headers, http, payload), "", hi + 4


def read_member(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What the gzip member at ``at`` holds, and where it ends; of a broken one what
    could be inflated, and none."""
    d, out, i = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            if i >= len(data):
                return b"".join(out), None
            out.append(d.decompress(data[i : i + STEP]))
            i += STEP
    except zlib.error:
        return _inflated(data, at, i), None
    return b"".join(out), min(i, len(data)) - len(d.unused_data)


def _inflated(data: bytes, at: int, last: int) -> bytes:
    """The beginning of a broken member up to the byte that breaks it, which lies in
    the step from ``last`` on."""
    d = zlib.decompressobj(31)
    out = [d.decompress(data[at:last])]
    try:
        for i in range(last, min(last + STEP, len(data))):
            out.append(d.decompress(data[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


class Places:
    """The next place of a byte string; each place is searched for once."""

    def __init__(self, data: bytes, what: bytes):
        self.data, self.what, self.at = data, what, -1

    def after(self, at: int) -> int:
        """The first place behind ``at``, the end if there is none. ``at`` ascends."""
        if self.at <= at:
            found = self.data.find(self.what, at + 1)
            self.at = len(self.data) if found < 0 else found
        return self.at


def member_records(inner: bytes, at: int, end: int) -> tuple[list[Found], bool]:
    """The records and gaps inside a member, and whether it has a record."""
    found: list[Found] = []
    versions, i, good = Places(inner, VERSION), 0, not inner
    while i < len(inner):
        record, reason, after = parse_record(inner, i)
        if record is not None:
            found.append(record._replace(start=at, end=end))
            good, i = True, after
        else:
            found.append(Found(at, end, reason, {}, {}, b""))
            i = versions.after(i)
    return found, good


def salvage(data: bytes) -> Iterator[Found]:
    """All records that can be read, in order, and the gaps between them. Of a
    broken member the records of its beginning are kept; the rest is a gap."""
    at, gap, why = 0, None, ""
    magics, versions = Places(data, MAGIC), Places(data, VERSION)

    def closed(to: int) -> list[Found]:
        nonlocal gap
        out = [] if gap is None or gap == to else [Found(gap, to, why, {}, {}, b"")]
        gap = None
        return out

    while at < len(data):
        found: list[Found] = []
        reason, end, good = "no member and no record", at, False
        if data[at : at + 3] == MAGIC:
            inner, whole = read_member(data, at)
            if whole is None:
                reason = "bad gzip member"
                kept = [f for f in member_records(inner, at, at)[0] if f.reason is None]
                if kept:
                    yield from closed(at)
                    yield from kept
            else:
                end = whole
                found, good = member_records(inner, at, end)
                reason = reason if good or not found else found[0].reason
        else:
            record, reason, end = parse_record(data, at)
            if record is not None:
                found, good = [record], True
        if good:
            yield from closed(at)
            yield from found
            at = end
        else:
            if gap is None:
                gap, why = at, reason
            at = min(magics.after(at), versions.after(at))
    yield from closed(len(data))


RECORDS = "file string, start long, end long, reason string, record_id string, record_type string, target_uri string, payload_digest string, refers_to string, http_length long, payload binary"


def read_warc(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """One row per record or quarantined gap (``reason`` not null) of the WARC
    files (plain or gzip by member) below ``path`` whose names fit ``pattern``. A
    file is read by one task and may have up to 2 GB."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                rows, held = [], 0
                name = file.as_py()
                for f in salvage(content.as_py()):
                    h = f.headers
                    length = f.http.get("content-length", "")
                    rows.append((name, f.start, f.end, f.reason, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, h.get("warc-refers-to"), int(length) if length.isdigit() else None, f.payload))
                    held += len(f.payload)
                    if held > 4_000_000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(run, RECORDS)


def page_of(column: str):
    """The page id in a record id; null if there is none."""
    return F.regexp_extract(F.col(column), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the
    records read back: of responses from the payload itself, of revisits from
    the headers they carry."""
    again = F.col("record_type") == "revisit"
    return records.where("reason IS NULL").select(
        page_of("record_id").alias("page_id"),
        F.when(again, F.col("http_length")).otherwise(F.length("payload").cast("long")).alias("payload_bytes"),
        F.when(again, F.col("payload_digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        F.when(again, page_of("refers_to")).alias("refers_to"),
    )
