"""Repeated passages by a sparse suffix array.

1. Of all suffixes (word positions) those at minimisers are kept: the position of
   the smallest hash of ``GRAM`` words among ``WINDOW`` neighbours.  Positions are
   chosen by content: each window of ``LEAST`` words belongs to the minimiser of its
   first ``WINDOW`` words, the same one in every document, with at least ``CORE`` of
   its words to the right.  A suffix owns consecutive windows; the text they cover
   is its context.
2. Suffixes whose first ``CORE`` words stand in more than one document remain.
   Where they all have one context, all its windows are repeated.
3. Of the others every context gives the hashes of its windows, with its first place
   and its smallest and largest ``doc_id``.  Windows of more than one document are
   matches, however many contexts share a core.  Longer passages are tiled by the
   windows of several minimisers.

Of each matched window the smallest (doc_id, position) is the copy that stays; of
the others the window's words are marked to be cut, except where they overlap the
copy itself (a text that repeats itself with a period of less than ``LEAST`` words).
The copy that stays may lose words to a window whose copy stands at a smaller place,
so a word that is cut always stands in the copy of some window that has it.  Contexts
are counted before they are shuffled, and joins are on keys that Spark can split.

Words are runs of characters other than ASCII white space, compared as they are.
Only matches between different ``doc_id`` count.  Null and empty texts, texts of
less than ``LEAST`` words and rows with a null id have no matches.  Rows that
repeat an id with another text are told apart by a hash of the text; equal rows
share their spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.frames import apart, bloom, cut_lineage, in_bloom

LEAST, GRAM, WINDOW = 50, 12, 25
CORE = LEAST - WINDOW + 1


class _Slice:
    """Word hashes and kept suffixes of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        hasher = B.span_hasher(data)
        starts, ends, first = B.words(data, offsets)
        h = hasher(starts, ends)
        n = len(h)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        if n < LEAST:
            self.at = self.begin = last = np.zeros(0, np.int64)
        else:
            view = np.lib.stride_tricks.sliding_window_view(B.window_hashes(h, GRAM), WINDOW)[: n - LEAST + 1]
            where = np.flatnonzero(owner[: len(view)] == owner[LEAST - 1 :])  # starts of the windows of LEAST words
            best = np.concatenate([view[part].argmin(axis=1) + part for part in np.array_split(where, len(where) // 65536 + 1)])
            self.at, begin = np.unique(best, return_index=True)  # a minimiser's windows are consecutive
            self.begin, last = where[begin], where[np.append(begin, len(where))[1:] - 1]
        self.text = owner[self.at]
        self.pos = self.at - first[:-1][self.text]
        self.most, self.least = self.at - self.begin, self.at - last  # words to the left in its first and last window
        up, down = B._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=total[1:])
        self.spans = lambda a, b: B.mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        self.core = self.spans(self.at, self.at + CORE)
        self.ctx = B.mix(self.spans(self.begin, last + LEAST) + self.most.astype(np.uint64))

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """One long per suffix, for the Bloom filter."""
        return B.mix(self.core ^ B.mix(self.ctx + ids[self.text].view(np.uint64) + B.mix(self.pos.astype(np.uint64)))).view(np.int64)

    def windows(self, chosen: np.ndarray) -> pa.ListArray:
        """Hashes of the windows of the chosen suffixes, from the one with most words to the left."""
        counts = (self.most - self.least)[chosen] + 1
        offsets = np.append(0, np.cumsum(counts))
        at = np.repeat(self.begin[chosen] - offsets[:-1], counts) + np.arange(offsets[-1])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.spans(at, at + LEAST).view(np.int64)))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[_Slice, np.ndarray, np.ndarray]]:
    batch = batch.filter(batch.column("doc_id").is_valid())
    ids, row = (batch.column(c).to_numpy() for c in ("doc_id", "row"))
    data, offsets = B.text_bytes(batch.column("text"))
    for lo, hi, part, offs in B.slices(data, offsets):
        yield _Slice(part, offs), np.ascontiguousarray(ids[lo:hi]), row[lo:hi]


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")


def kept_suffixes(docs: DataFrame) -> DataFrame:
    """(core, ctx, doc_id, row, pos, most, least) of the suffixes at minimisers."""
    names = ["core", "ctx", "doc_id", "row", "pos", "most", "least", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, ids, row in _slices(batch):
                columns = [s.core.view(np.int64), s.ctx.view(np.int64), ids[s.text], row[s.text], s.pos.astype(np.int32), s.most.astype(np.int8), s.least.astype(np.int8), s.keys(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return _identified(docs).mapInArrow(run, "core long, ctx long, doc_id long, row long, pos int, most byte, least byte, key long")


def context_windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per ctx, with the key of one suffix that has it) with the hashes of the context's windows."""
    shared = bloom(wanted, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for s, ids, _ in _slices(batch):
                keys = s.keys(ids)
                chosen = np.flatnonzero(in_bloom(bits, keys))
                yield pa.RecordBatch.from_arrays([pa.array(s.ctx.view(np.int64)[chosen]), pa.array(keys[chosen]), s.windows(chosen)], ["ctx", "key", "windows"])

    found = _identified(docs).mapInArrow(run, "ctx long, key long, windows array<long>")
    return found.join(wanted, ["key", "ctx"]).drop("key").dropDuplicates(["ctx"])


def _merged(spans: DataFrame, name: str) -> DataFrame:
    """Union of (doc_id, row, start, end) spans as one sorted array per document."""
    keys = ["doc_id", "row"]
    order = W.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    flagged = spans.withColumn("_new", (before.isNull() | (F.col("start") > before)).cast("int"))
    group = flagged.withColumn("_g", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = group.groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(name))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans, cuts) of every document that shares a passage of ``LEAST`` words or more.

    ``spans`` are all repeated passages, ``cuts`` those of which another copy stays: sorted, disjoint word ranges (end exclusive)."""
    suffixes = cut_lineage(kept_suffixes(docs), "suffixes")
    cores = suffixes.groupBy("core").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).where("d0 <> d1").select("core")
    shared = cut_lineage(suffixes.join(cut_lineage(cores, "cores"), "core"), "shared")  # written, so that a common core is split in the join
    place = F.struct("doc_id", "row", "pos", "key")
    groups = shared.groupBy("core", "ctx").agg(F.max("doc_id").alias("d1"), F.min(place).alias("first"), F.max("most").alias("most"), F.min("least").alias("least"))
    groups = cut_lineage(groups.select("core", "ctx", "d1", "first.*", "most", "least"), "contexts")
    several = cut_lineage(groups.groupBy("core").agg((F.count(F.lit(1)) > 1).alias("several")), "several")  # written for the same reason
    groups = cut_lineage(groups.join(several, "core").drop("core"), "counted")

    whole = groups.where("NOT several").select("ctx", F.struct("doc_id", "row", "pos").alias("stays"), "most", "least")
    wanted = groups.where("several").select("ctx", "key", "d1", "doc_id", "row", "pos", "most")
    windows = cut_lineage(context_windows(docs, wanted), "windows")
    windows = windows.select("ctx", "d1", "doc_id", "row", "pos", "most", F.posexplode("windows").alias("i", "window"))
    windows = windows.withColumn("l", F.col("most") - F.col("i"))
    begins = F.struct("doc_id", "row", (F.col("pos") - F.col("l")).alias("start"))
    repeated = windows.groupBy("window").agg(F.max("d1").alias("d1"), F.min(begins).alias("stays")).where("stays.doc_id <> d1").select("window", "stays")
    repeated = cut_lineage(repeated, "repeated")
    stays = F.struct(F.col("stays.doc_id").alias("doc_id"), F.col("stays.row").alias("row"), (F.col("stays.start") + F.col("l")).alias("pos"))
    reached = windows.select("ctx", "window", "l").join(repeated, "window").select("ctx", stays.alias("stays"), "l")
    reached = reached.groupBy("ctx", "stays").agg(F.max("l").alias("most"), F.min("l").alias("least"))  # windows between two that are repeated there are repeated there, too
    matches = cut_lineage(whole.union(reached), "matches")

    found = shared.select("ctx", "doc_id", "row", "pos").join(matches, "ctx")
    stay = (F.col("doc_id") == F.col("stays.doc_id")) & (F.col("row") == F.col("stays.row")) & (F.abs(F.col("pos") - F.col("stays.pos")) < LEAST)
    found = found.select("doc_id", "row", (F.col("pos") - F.col("most")).alias("start"), (F.col("pos") - F.col("least") + LEAST).alias("end"), stay.alias("stay"))
    found = cut_lineage(found, "found")
    spans, cuts = found.drop("stay"), found.where("NOT stay").drop("stay")
    out = _merged(spans.distinct(), "spans").join(_merged(cuts.distinct(), "cuts"), ["doc_id", "row"], "left")
    return out.select("doc_id", "row", "spans", F.coalesce("cuts", F.array().cast("array<struct<start:int,end:int>>")).alias("cuts"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the cut passages taken out of ``text``; all rows stay, and their other columns as they are."""
    mine = apart(docs, ("doc_id", "text"))
    passages = repeated_passages(mine).where(F.size("cuts") > 0).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("cuts").alias("_cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, (text, cuts) in enumerate(zip(texts, batch.column("_cuts").to_pylist(), strict=True)):
                if cuts:
                    data = np.frombuffer(text.encode(), np.uint8)
                    starts, _, _ = B.words(data, np.array([0, len(data)]))
                    at, parts = 0, []
                    for c in cuts:
                        parts.append(data[at : starts[c["start"]]].tobytes())
                        at = int(starts[c["end"]]) if c["end"] < len(starts) else len(data)
                    texts[i] = (b"".join(parts) + data[at:].tobytes()).decode()
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            yield out.select([c for c in out.schema.names if c != "_cuts"])

    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_row"))
    joined = mine.join(passages, same, "left").select(*[F.col(f"`{c}`") for c in mine.columns], "_cuts")
    return joined.mapInArrow(cut, mine.schema).toDF(*docs.columns)
