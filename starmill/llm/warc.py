"""WARC archives: a writer with revisit records and a salvage reader.

Archives are written and read by Spark's own sources, so any store that Spark
reaches will do. A record is a gzip member. Spark's text writer puts a
separator after every value; here that is an empty gzip member, which keeps
the file a valid sequence of members.

The reader checks every member or record. Where a check fails, it searches for
the next valid member or version line, goes on there, and logs the bytes in
between as quarantined.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import fitting, map_arrow, written

MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
#: An empty gzip member (fixed bytes of the format), as the characters of the same numbers.
EMPTY_MEMBER = (b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + b"\x00" * 8).decode("latin-1")
CUT_OFF = "gzip member cut off"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if re.search(r"[\r\n]", value) else value


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit with the headers of a response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_line(url)}")
    headers += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"WARC-Block-Digest: sha1:{payload_digest(block)}"]
    if refers_to is not None:
        headers += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    headers += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = 2000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for every row of ``pages`` (page_id, url, html) into gzipped archives under ``path``.

    Of the rows with equal payloads of at least ``least_bytes`` that with the
    smallest page_id is a response and the others refer to it; rows repeated
    with that id are responses too. Null html is an empty payload; a null id is
    never referred to. Other columns are left out.
    """
    thin = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    thin = thin.withColumn("digest", F.sha1("payload"))
    groups = thin.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = fitting(written(groups.where("n > 1 and first is not null").select(F.col("digest").alias("of"), "first"), "equal-payloads"))
    named = thin.join(groups, F.col("digest") == F.col("of"), "left").select("page_id", "url", "payload", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True)
            yield pa.record_batch([pa.array([member(record_bytes(*row, date)) for row in rows], pa.binary())], names=["value"])

    members = map_arrow(named, pack, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", EMPTY_MEMBER).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_file).text(path)


@dataclass
class Found:
    """A record (``headers`` and ``payload``) or, with ``reason``, a quarantined gap."""

    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    http: bytes = b""
    reason: str | None = None


def _record(data: bytes, at: int) -> tuple[Found | None, int, str]:
    """The record at ``at`` and where it ends, or none and why not."""
    # headers end anywhere: another version line among them has no colon and is refused as one
    head_end = data.find(b"\r\n\r\n", at) if data.startswith(VERSION, at) else -1
    if head_end < 0:
        return None, at, "no version line or headers"
    headers = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            return None, at, "malformed header"
        headers[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "surrogateescape")
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return None, at, "no content length"
    begin, end = head_end + 4, head_end + 4 + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        return None, at, "content length doesn't fit"
    block = data[begin:end]
    if (digest := headers.get("warc-block-digest", "")).startswith("sha1:") and digest[5:] != payload_digest(block):
        return None, at, "block digest differs"
    http, split, payload = block.partition(b"\r\n\r\n")
    if not split:
        http, payload = b"", block
    if headers.get("warc-type") == "response" and (digest := headers.get("warc-payload-digest", "")).startswith("sha1:") and digest[5:] != payload_digest(payload):
        return None, at, "payload digest differs"
    return Found(at, end + 4 - at, headers, payload, http), end + 4, ""


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` holds, where it ends, and what is wrong with it; a broken one gives what stands before the fault."""
    unpacker, view, p = zlib.decompressobj(31), memoryview(data), at
    parts = []
    while not unpacker.eof and p < len(data):
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(view[p : p + 65536]))
        except zlib.error as error:
            # an error takes the whole call's output with it, so the call is repeated byte by byte
            with contextlib.suppress(zlib.error):
                for i in range(p, min(p + 65536, len(data))):
                    parts.append(before.decompress(view[i : i + 1]))
            return b"".join(parts), at, f"gzip: {error}"
        p += 65536
    if not unpacker.eof:
        return b"".join(parts), at, CUT_OFF
    return b"".join(parts), min(p, len(data)) - len(unpacker.unused_data), ""


_LINE = re.compile(rb"(?<=\n)" + re.escape(VERSION))
_NEXT = re.compile(re.escape(MAGIC) + rb"|" + _LINE.pattern)


def _salvaged(plain: bytes, proved: bool) -> Iterator[Found]:
    """Records of a member's bytes, and a gap for every stretch that holds none; ``proved`` takes records with a block digest only."""
    at, gap, why = 0, None, ""
    while at < len(plain):
        record, end, reason = _record(plain, at)
        if record is not None and proved and "warc-block-digest" not in record.headers:
            record, reason = None, "no digest in a broken member"
        if record is not None:
            if gap is not None:
                yield Found(gap, at - gap, reason=why)
                gap = None
            yield record
            at = end
            continue
        if gap is None:
            gap, why = at, reason
        following = _LINE.search(plain, at + 1)
        at = following.start() if following else len(plain)
    if gap is not None:
        yield Found(gap, at - gap, reason=why)


def read_archive(data: bytes) -> Iterator[Found]:
    """Records of an archive in order, plain or gzipped or both, and the gaps between those that could be read.

    A member that fails its checks gives the records that their own digests
    prove, unless all agree with theirs and the fault is in a header, and is a
    gap as a whole; so does one that is cut off. In a sound member a bad record
    is a gap with the member's place, and its place among the unpacked bytes in
    the reason.
    """
    at, gap, why = 0, None, ""
    while at < len(data):
        found, end, reason = [], at, "neither a member nor a record"
        if data.startswith(MAGIC, at):
            plain, end, reason = _member(data, at)
            found = list(_salvaged(plain, proved=bool(reason)))
            if reason:
                # digests don't cover headers: where every record agrees, the fault is in one of those
                found = [r for r in found if not r.reason] if any(r.reason for r in found) or reason == CUT_OFF else []
                if found:
                    reason += f" after {len(found)} record{'s' * (len(found) > 1)}"
            else:
                for r in found:
                    if r.reason:
                        r.reason += f", bytes {r.offset} to {r.offset + r.length} of the member"
            for r in found:
                r.offset, r.length = at, max(end - at, 0)
        else:
            record, end, reason = _record(data, at)
            found = [record] if record else []
        if not reason:
            if gap is not None:
                yield Found(gap, at - gap, reason=why)
                gap = None
            yield from found
            at = end
            continue
        if found and gap is not None:
            yield Found(gap, at - gap, reason=why)
            gap = None
        yield from found
        if gap is None:
            gap, why = at, reason
        following = _NEXT.search(data, at + 1)
        at = following.start() if following else len(data)
    if gap is not None:
        yield Found(gap, at - gap, reason=why)


_ROWS = "file string, offset long, length long, reason string, record_type string, page_id long, url string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_URN = re.compile(r"<urn:page:(-?[0-9]+)>")


def _number(value: str | None) -> int | None:
    m = _URN.fullmatch(value or "")
    return int(m[1]) if m else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, and one with ``reason`` per quarantined gap, of all archives under ``path``.

    ``payload_bytes`` and ``payload_digest`` are those of the whole payload:
    counted from a response's bytes, taken from a revisit's headers. An archive
    is read as a whole, which ``records_per_file`` bounds when it is written.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows: list[tuple] = []
                held = 0
                for r in read_archive(content.as_py()):
                    if r.reason:
                        rows.append((name, r.offset, r.length, r.reason, *[None] * 7))
                        continue
                    revisit = r.headers.get("warc-type") == "revisit"
                    if revisit:
                        stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", r.http)
                        size, digest = int(stated[1]) if stated else None, r.headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    else:
                        size, digest = len(r.payload), payload_digest(r.payload)
                    rows.append((name, r.offset, r.length, None, r.headers.get("warc-type"), _number(r.headers.get("warc-record-id")), r.headers.get("warc-target-uri"), _number(r.headers.get("warc-refers-to")), size, digest, None if revisit else r.payload))
                    held += len(r.payload)
                    if held > 1 << 24:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return map_arrow(files, read, _ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [(name, kinds[kind]) for name, kind in (x.split() for x in _ROWS.split(", "))]
    return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])
