"""Token-ID output as length-delimited binary records.

A file is a sequence of frames::

    length of the payload   unsigned 64-bit, little-endian
    masked CRC-32 of the eight length bytes
    payload
    masked CRC-32 of the payload
    0A

The mask is rotate right by 15 bits plus a constant, so that a checksum of data
that holds checksums stays useful.  The payload is one serialized sequence: a
flag byte (1: document id present), the document id (signed 64-bit), the width
of an id in bytes (2 when the vocabulary fits, else 4), then the ids.

Documents stand in ascending ``doc_id`` order (null ids first, equal ids next to
each other) over files ``part-00000``, ``part-00001`` ...; Spark's own text
writer writes the bytes, so a lost executor or a repeated task leaves no torn
file.  ``write_index`` scans the frames' heads and writes a table (file,
record, offset, length, doc_id, n_tokens) for shuffled reads: ``read_shuffled``
takes any of its rows in any order, seeks to their offsets and reads no other frame.  ``read_records`` checks both checksums of every
frame and raises ValueError on a damaged one.

Null texts are empty texts: their record holds the end id alone.  Empty tables
write no frame and read back as no row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.tokens import encoder

# Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
HEAD, TAIL, PAYLOAD = "<QI", "<I", "<BqB"
HEAD_BYTES, TAIL_BYTES, PAYLOAD_BYTES = map(struct.calcsize, (HEAD, TAIL, PAYLOAD))
LINE_END = "\n"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One frame without its last byte, which the writer adds."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(TAIL, masked(length)) + payload + struct.pack(TAIL, masked(payload))


def frames(data: bytes | memoryview, payloads: bool = True) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each frame of a file; only heads are checked without ``payloads``."""
    view, at = memoryview(data), 0
    while at < len(view):
        if at + HEAD_BYTES > len(view):
            raise ValueError(f"a frame is cut short at byte {at}")
        length, crc = struct.unpack_from(HEAD, view, at)
        if crc != masked(bytes(view[at : at + 8])):
            raise ValueError(f"the length at byte {at} does not match its checksum")
        end = at + HEAD_BYTES + length
        if end + TAIL_BYTES + 1 > len(view):
            raise ValueError(f"the payload at byte {at} is cut short")
        payload = view[at + HEAD_BYTES : end]
        if payloads and struct.unpack_from(TAIL, view, end)[0] != masked(payload):
            raise ValueError(f"the payload at byte {at} does not match its checksum")
        yield at, payload
        at = end + TAIL_BYTES + 1


def serialize(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(PAYLOAD, doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def parse(payload: memoryview) -> tuple[int | None, np.ndarray]:
    has, doc_id, width = struct.unpack_from(PAYLOAD, payload, 0)
    return (doc_id if has else None), np.frombuffer(payload, dtype=f"<u{width}", offset=PAYLOAD_BYTES).astype("<u4")


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode ``text`` of every row (plus ``end_id``) and write the frames in ``doc_id`` order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                ids, bounds = enc.encode(part, offs)
                out = [frame(serialize(doc_ids[i], np.concatenate([ids[bounds[i - lo] : bounds[i - lo + 1]], end]), width)) for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", LINE_END).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a record folder with their place in the order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("file"), "content")


def write_index(spark: SparkSession, folder: str, index: str) -> None:
    """Scan the heads of all frames and write the offset index as a table."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for record, (offset, payload) in enumerate(frames(content.as_buffer(), payloads=False)):
                    has, doc_id, width = struct.unpack_from(PAYLOAD, payload, 0)
                    rows.append((file, record, offset, len(payload), doc_id if has else None, (len(payload) - PAYLOAD_BYTES) // width))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    names = ["file", "record", "offset", "length", "doc_id", "n_tokens"]
    kinds = pa.schema([("file", pa.int32()), *[(n, pa.int64()) for n in names[1:]]])
    _files(spark, folder).mapInArrow(scan, "file int, record long, offset long, length long, doc_id long, n_tokens long").write.parquet(index)


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Read the files back: (file, record, doc_id, start_in_file, n_tokens, ids_crc32[, ids]).

    ``ids`` are little-endian unsigned 32-bit integers; ``start_in_file`` counts the ids before the record in its file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                columns: list[list] = [[] for _ in range(7)]
                start = held = record = 0
                for _, payload in frames(content.as_buffer()):
                    doc_id, ids = parse(payload)
                    raw = ids.tobytes()
                    for column, value in zip(columns, (file, record, doc_id, start, len(ids), zlib.crc32(raw), raw if with_ids else None), strict=True):
                        column.append(value)
                    start, held, record = start + len(ids), held + len(raw), record + 1
                    if held > 8 << 20 and with_ids or len(columns[0]) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][:width], names)
                        columns, held = [[] for _ in range(7)], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][:width], names)

    width = 7 if with_ids else 6
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
    names = ["file", "record", "doc_id", "start_in_file", "n_tokens", "ids_crc32", "ids"][:width]
    schema = "file int, record long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return _files(spark, folder).mapInArrow(read, schema)


def read_shuffled(spark: SparkSession, folder: str, places: DataFrame, batch: int = 4096) -> DataFrame:
    """The records at index rows in an order of the caller's: (place, doc_id, n_tokens, ids), sorted by ``place``.

    ``places`` has (place, file, offset); a record may be asked for several times.  The rows are
    dealt by file and by blocks of ``batch`` places, each block seeks its own offsets, and both
    checksums of a frame that is read are checked.  The records are then sorted into the order of
    their places, over ranges of it."""
    blocks = places.groupBy("file", (F.col("place") / batch).cast("long").alias("block")).agg(F.collect_list(F.struct("place", "offset")).alias("wanted"))

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, wanted in zip(b.column("content"), b.column("wanted").to_pylist(), strict=True):
                view, columns = memoryview(content.as_buffer()), [[], [], [], []]
                for w in wanted:
                    length = struct.unpack_from("<Q", view, w["offset"])[0] if w["offset"] + HEAD_BYTES <= len(view) else 0
                    end = w["offset"] + HEAD_BYTES + length + TAIL_BYTES + 1
                    _, payload = next(frames(view[w["offset"] : end]), (0, None))
                    if payload is None:
                        raise ValueError(f"no frame at byte {w['offset']}")
                    doc_id, ids = parse(payload)
                    for column, value in zip(columns, (w["place"], doc_id, len(ids), ids.tobytes()), strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "doc_id", "n_tokens", "ids"])

    rows = _files(spark, folder).join(blocks, "file").select("content", "wanted").mapInArrow(seek, "place long, doc_id long, n_tokens long, ids binary")
    return rows.repartitionByRange("place").sortWithinPartitions("place")


def file_starts(index: DataFrame) -> DataFrame:
    """(file, file_start): ids in all files before; one row per file."""
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
