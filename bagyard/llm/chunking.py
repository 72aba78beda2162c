"""Document fingerprints from content-defined chunks.

A gear hash of the last 32 bytes decides where a chunk ends: before ``AVERAGE``
bytes the strict mask must be clear, after it the loose one (normalised
chunking), between ``LEAST`` and ``MOST`` bytes.  A boundary depends on the bytes
before it only, so an insertion moves the chunks around it and no others.  A
fingerprint is the set of (52-bit digest, length) of the chunks, as sorted
16-digit hexadecimal numbers.  Likeness of two sets is the length-weighted
containment taken from both sides, 2 * shared / (a + b): 1 for equal sets, two
empty ones included, 0 for sets without a common chunk.

``edited_fingerprints`` orders documents by descending ``doc_id`` (null last; equal
ids by hash of the text) and pairs each with the next one, the last with the
first.  Documents are dealt to id ranges once, together with the first document
of the following range, so texts are shuffled a single time and a task holds a
batch of texts at a time.

Null texts are empty texts; a single document is its own next one.  An empty
table gives no rows.
"""

from __future__ import annotations

import binascii
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B

LEAST, AVERAGE, MOST = 32, 64, 256  # LEAST covers the hash's window, so a chunk's end depends on its own bytes
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF8000000)
_GEAR = np.random.Generator(np.random.PCG64(10)).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash (shift left, add) of the 32 bytes that end at each byte."""
    h = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] += h[:-shift] << np.uint32(shift)
    return h


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, text) of every chunk of several texts, in order."""
    h = gear(data)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = loose[(h[loose] & STRICT) == 0]
    loose, strict = (np.append(x, len(data) + MOST) for x in (loose, strict))
    text = np.flatnonzero(np.diff(offsets) > 0)
    at, stop = offsets[text], offsets[text + 1]
    ends, owners = [], []
    while len(at):  # one chunk of every text at a time
        first = strict[np.searchsorted(strict, at + LEAST - 1)] + 1
        second = loose[np.searchsorted(loose, at + AVERAGE - 1)] + 1
        end = np.where(first < at + AVERAGE, first, np.minimum(second, at + MOST))
        end = np.minimum(end, stop)
        ends.append(end)
        owners.append(text)
        more = end < stop
        at, stop, text = end[more], stop[more], text[more]
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end, owner = np.concatenate(ends), np.concatenate(owners)
    order = np.argsort(end, kind="stable")
    return end[order], owner[order]


def chunk_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text the sorted distinct chunks: digest in the upper 52 bits, length in the lower 12."""
    end, owner = chunks(data, offsets)
    start = np.append(0, end[:-1])
    value = (B.span_hashes(data, start, end) & ~np.uint64(0xFFF)) | (end - start).astype(np.uint64)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[keep], owner[keep]
    cut = np.searchsorted(owner, np.arange(len(offsets)))
    return [value[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def fingerprint(chunk_set: np.ndarray) -> str:
    return binascii.hexlify(chunk_set.astype(">u8").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    size = lambda x: int((x & np.uint64(0xFFF)).sum())
    return 2 * size(np.intersect1d(a, b, assume_unique=True)) / (size(a) + size(b))


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each code point begins, and per text the index of its first one (n + 1 entries)."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    return begins, np.searchsorted(begins, offsets)


class _Row:
    """What the document before needs of this one."""

    __slots__ = ("chars", "doc_id", "data", "part", "set")

    def __init__(self, doc_id: int | None, data: bytes, part: int):
        self.doc_id, self.data, self.part = doc_id, data, part
        self.chars = self.set = None


def _pairs(rows: list[_Row], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    """Results of every row whose next row has the same part."""
    new = [r for r in rows if r.set is None]
    offsets = np.cumsum([0, *[len(r.data) for r in new]])
    data = np.frombuffer(b"".join(r.data for r in new), np.uint8)
    begins, first = _characters(data, offsets)
    for i, (r, found) in enumerate(zip(new, chunk_sets(data, offsets), strict=True)):
        r.set, r.chars = found, begins[first[i] : first[i + 1]] - offsets[i]
    edited, done = [], []
    for r, after in zip(rows[:-1], rows[1:], strict=True):
        if r.part != after.part:
            continue
        half = len(r.chars) // 2
        kept = r.data if not half else r.data[: int(r.chars[len(r.chars) - half])]
        edited.append(kept + (after.data if half >= len(after.chars) else after.data[: int(after.chars[half])]))
        done.append((r, after))
    offsets = np.cumsum([0, *map(len, edited)])
    sets = chunk_sets(np.frombuffer(b"".join(edited), np.uint8), offsets)
    out = [(r.doc_id, len(r.chars), hashlib.sha256(e).hexdigest(), fingerprint(r.set), fingerprint(s), likeness(r.set, s), likeness(r.set, after.set)) for (r, after), e, s in zip(done, edited, sets, strict=True)]
    columns = zip(*out, strict=True) if out else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a bounded number of id ranges, the first holding the largest ids, null ids behind all
    inner = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100_000)).first()[0] or []
    bounds = np.unique(np.array(inner, dtype=np.int64))

    def place(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        return np.where(null, len(bounds) + 1, len(bounds) - np.searchsorted(bounds, ids, side="right"))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        null = ids.isna().to_numpy()
        return pd.Series(place(ids.fillna(0).astype("int64").to_numpy(), null).astype(np.int32))

    firsts = docs.select(part_of("doc_id").alias("part"), "doc_id").groupBy("part").agg(F.max("doc_id").alias("first")).orderBy("part").collect()  # a row per range
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    wanted: dict[int | None, int] = {}  # first document of a range -> the range before it
    for before, after in zip(firsts, [*firsts[1:], firsts[0]], strict=True):
        wanted[after["first"]] = before["part"]
    keys = np.array(sorted(k for k in wanted if k is not None), dtype=np.int64)
    targets = np.array([wanted[k] for k in keys.tolist()], dtype=np.int32)
    null_target = wanted.get(None, -1)

    @F.pandas_udf("int")
    def guest_of(ids: pd.Series) -> pd.Series:
        null = ids.isna().to_numpy()
        at = ids.fillna(0).astype("int64").to_numpy()
        found = np.full(len(at), -1, np.int32)
        if len(keys):
            i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
            found = np.where(keys[i] == at, targets[i], -1)
        return pd.Series(np.where(null, null_target, found).astype(np.int32))

    own, guest = F.struct(part_of("doc_id").alias("part"), F.lit(False).alias("guest")), F.struct(guest_of("doc_id").alias("part"), F.lit(True).alias("guest"))
    rows = docs.withColumn("_at", F.explode(F.array(own, guest))).select("doc_id", "text", F.col("_at.part").alias("part"), F.col("_at.guest").alias("guest")).where("part >= 0")
    rows = rows.withColumn("_h", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "part").sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "_h", "text")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Row] = []
        size, closed = 0, -1
        for batch in batches:
            data, offsets = B.text_bytes(batch.column("text"))
            ids, part, is_guest = (batch.column(c).to_pylist() for c in ("doc_id", "part", "guest"))
            for i in range(len(ids)):
                if is_guest[i] and (closed == part[i] or not held or held[-1].part != part[i]):
                    continue  # of guests only the first one counts
                closed = part[i] if is_guest[i] else closed
                held.append(_Row(ids[i], data[offsets[i] : offsets[i + 1]].tobytes(), part[i]))
                size += len(held[-1].data)
                if size > B.SLICE_BYTES:
                    yield _pairs(held, names, kinds)
                    held, size = held[-1:], 0
        if held:
            yield _pairs(held, names, kinds)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("doc_id", "text", "part", "guest").mapInArrow(run, schema)
