"""WARC archives: one gzip member per record, written by Spark and read back sequentially.

``write_archives`` writes a record per page.  Pages are grouped by payload
(SHA-256 and length, so equal keys are equal payloads); of a group the page with
the largest id is a ``response``, the others are ``revisit`` records that refer
to it and carry no payload.  Payloads below ``min_revisit_bytes`` are always
responses.  Rows that repeat the largest id are responses too; a null id counts
as smaller than any other, and a group with no id at all holds responses only.
Null html is an empty payload, a null url leaves out the target header.

The bytes go through Spark's text writer, so a lost executor or a repeated task
leaves no torn archive.  The writer ends each row with a zero byte, which is the
last byte of any gzip member of less than 16 MiB (the high byte of its length);
larger members keep theirs and the zero after them is padding, which readers of
gzip skip.

``read_archives`` reads each archive from start to end: incremental zlib
decompression in blocks of ``CHUNK`` bytes, records framed by Content-Length,
block and payload digests checked on the way.  A torn member, a missing header
or a digest that does not match raises ValueError.  A whole archive is one
value of Spark's binary file source, so archives are as large as the write
partitions; the payloads themselves are never all in memory unless asked for.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 16
WRITE_DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, payload_digest: str, length: int, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``payload`` is None) has the HTTP head of its page and no body."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Date: {WRITE_DATE}"]
    lines.append(f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if payload is None:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
        lines.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{payload_digest}')}>")
        lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Member:
    """Bytes of the gzip members of an archive, decompressed a block at a time."""

    def __init__(self, data: memoryview):
        self.data, self.at = data, 0

    def next(self) -> bool:
        """Go to the next member; zero bytes between members are padding."""
        while self.at < len(self.data) and self.data[self.at] == 0:
            self.at += 1
        self.unpacker, self.held, self.pending = zlib.decompressobj(31), b"", b""
        return self.at < len(self.data)

    def _more(self) -> bytes:
        """The next decompressed bytes, at most CHUNK; empty at the member's end."""
        while not self.unpacker.eof:
            given = self.pending
            if not given:
                if self.at >= len(self.data):
                    raise ValueError("an archive ends within a gzip member")
                given = bytes(self.data[self.at : self.at + CHUNK])
                self.at += len(given)
            out = self.unpacker.decompress(given, CHUNK)
            self.pending = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.at -= len(self.unpacker.unused_data)
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``."""
        while (end := self.held.find(mark)) < 0:
            if not (more := self._more()):
                raise ValueError("a record ends before its head does")
            self.held += more
        out, self.held = self.held[: end + len(mark)], self.held[end + len(mark) :]
        return out

    def blocks(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in parts."""
        while n:
            part = self.held[:n] if self.held else self._more()
            if not part:
                raise ValueError("a record is shorter than its Content-Length")
            if self.held:
                self.held = self.held[len(part) :]
            elif len(part) > n:
                part, self.held = part[:n], part[n:]
            n -= len(part)
            yield part

    def end(self) -> None:
        while more := self._more():
            self.held += more
        if self.held != b"\r\n\r\n":
            raise ValueError("a member holds more than one record")


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def read_members(data: bytes | memoryview, with_payload: bool = False) -> Iterator[dict]:
    """Records of an archive in order, digests checked."""
    source = _Member(memoryview(data))
    while source.next():
        head = source.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("a member does not begin with a WARC record")
        h = _headers(head)
        left = int(h["content-length"])
        block = hashlib.sha1()
        http, payload, body, kept = b"", hashlib.sha1(), 0, []
        in_body = False
        for part in source.blocks(left):
            block.update(part)
            if not in_body:
                http += part
                if (end := http.find(b"\r\n\r\n")) < 0:
                    continue
                part, http, in_body = http[end + 4 :], http[: end + 4], True
            payload.update(part)
            body += len(part)
            if with_payload:
                kept.append(part)
        source.end()
        said = h.get("warc-payload-digest", "").removeprefix("sha1:")
        if h.get("warc-block-digest", "").removeprefix("sha1:") != base64.b32encode(block.digest()).decode():
            raise ValueError(f"block digest of {h.get('warc-record-id')} does not match")
        kind = h.get("warc-type")
        length = int(_headers(http)["content-length"])
        if kind == "response" and (said != base64.b32encode(payload.digest()).decode() or body != length):
            raise ValueError(f"payload digest of {h.get('warc-record-id')} does not match")
        number = lambda k: int(h[k]) if k in h else None
        yield {"page_id": number("x-page-id"), "url": h.get("warc-target-uri"), "payload_bytes": length, "payload_digest": said, "record_type": kind, "refers_to": number("x-refers-to-page-id"), "payload": b"".join(kept) if with_payload and kind == "response" else None}


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> None:
    """Write a record per row of (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("key", F.sha2("payload", 256))
    groups = rows.where(F.col("size") >= min_revisit_bytes).groupBy("key", "size").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    rows = rows.join(groups, ["key", "size"], "left").withColumn("refers_to", F.expr("CASE WHEN first IS NOT NULL AND NOT (page_id <=> first) THEN first END")).select("page_id", "url", "payload", "refers_to")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                body, first = payload.as_py(), refers_to.as_py()
                data = member(record(page_id.as_py(), url.as_py(), body if first is None else None, digest(body), len(body), first))
                out.append(data.removesuffix(b"\0"))
                held += len(data)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    rows.mapInArrow(members, "member binary").select(F.col("member").cast("string")).write.option("lineSep", "\0").text(folder)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Read every archive of a folder: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in read_members(memoryview(content.as_buffer()), with_payload):
                    rows.append(row)
                    held += row["payload_bytes"] if with_payload else 0
                    if len(rows) >= 10_000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").mapInArrow(read, schema)
