"""Best-fit packing of token sequences, bulk-synchronously.

Lengths and gaps are whole numbers up to ``capacity``.  Sorted by size, documents
and gaps therefore fall into at most ``capacity`` runs of equal size each, and a
superstep moves whole runs: for the next smaller length, a sweep over the sorted
gap runs finds the successor (the smallest gap that still fits), conflicts
between documents of one length are resolved by their rank, the gaps are
updated, and the next length follows.  One run at a time this does just what
best-fit decreasing does one document at a time.

What grows with the data runs on Spark: encoding, the histogram of lengths, the
rank of every piece among those of its length (``rank_within``) and the lookup
of its place.  The sweep sees the histogram only - ``capacity`` rows however
many documents there are - and gives a plan of (length, ranks, first sequence,
offset) runs.

Null texts count as empty; every document has its end id and so at least one
piece.  Repeated rows are packed as often as they stand.  An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.frames import cut_lineage, rank_within
from bagyard.llm.tokens import encoder


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Encode every text, add ``end_id`` and cut documents longer than ``capacity``: (doc_id, piece, start, length, ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                ids, bounds = enc.encode(part, offs)
                raw = ids.astype("<u4").tobytes()
                rows: list[tuple] = []
                for i in range(lo, hi):
                    doc = raw[4 * bounds[i - lo] : 4 * bounds[i - lo + 1]] + end
                    for piece, at in enumerate(range(0, len(doc), 4 * capacity)):
                        ids_here = doc[at : at + 4 * capacity]
                        rows.append((doc_ids[i], piece, at // 4, len(ids_here) // 4, ids_here))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids binary")


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Sweep over runs of equal lengths and gaps.

    Returns rows (length, first rank, items, items per sequence, first sequence, offset) and the number of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    plan: list[tuple[int, int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        left, rank = counts[length], 0

        def place(gap: int, first: int, number: int) -> None:
            """Fill sequences of one gap from the left over documents."""
            nonlocal left, rank
            each = gap // length
            for per, n in ((each, min(number, left // each)), (left % each, 1)):
                if n and per and number and left >= per and (per == each or left < each):
                    plan.append((length, rank, n * per, per, first, capacity - gap))
                    if gap - per * length:
                        gaps.setdefault(gap - per * length, []).append((first, n))
                    first, number, rank, left = first + n, number - n, rank + n * per, left - n * per
            if number:
                gaps.setdefault(gap, []).append((first, number))

        for gap in sorted(g for g in gaps if g >= length):
            if not left:
                break
            for first, number in gaps.pop(gap):
                if left:
                    place(gap, first, number)
                else:
                    gaps.setdefault(gap, []).append((first, number))
        if left:
            number = -(-left // (capacity // length))
            first, opened = opened, opened + number
            place(capacity, first, number)
    return np.array(plan, dtype=np.int64).reshape(-1, 6), opened


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with doc_id, piece and length; other columns are carried along."""
    pieces = cut_lineage(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan, _ = best_fit_plan(counts, capacity)
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast(plan[np.lexsort((plan[:, 1], plan[:, 0]))])
    ranked = rank_within(pieces, ["length"], F.xxhash64("doc_id", "piece"), [F.col("doc_id"), F.col("piece")], "_rank")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = (runs[:, 0] << np.int64(48)) + runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(keys, (length << np.int64(48)) + rank, side="right") - 1] if len(runs) else np.zeros((0, 6), np.int64)
            within = rank - run[:, 1]
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(run[:, 4] + within // run[:, 3]), pa.array(run[:, 5] + within % run[:, 3] * length)], names)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    names = schema.names
    return ranked.mapInArrow(assign, schema)
