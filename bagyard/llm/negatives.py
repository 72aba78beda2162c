"""op13: hard-negative mining with a secondary-sort shuffle.

Pair scores are packed into keys (anchor, descending score, kind, id), dealt by
anchor and sorted by Spark's shuffle (repartitionAndSortWithinPartitions); a
streaming iterator meets an anchor's positives and negatives by falling score,
opens a window at each positive and emits the negatives that fall into open
windows, holding only the open windows (5 at most), never an anchor's rows.

Anchors are the stated query set against all rows: both are dealt to blocks, each
pair of blocks is one bounded task.  Two passes over the blocks keep what is
shuffled small without losing a row: the first emits the 5 best positives of an
anchor within a block; the second, knowing an anchor's positives, emits of each
block the first 5 negatives of each window.  A row that is not among the first 5
of its block cannot be among the first 5 of all.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; a null vec_id is no anchor and comes last among equal
scores; rows that repeat a vec_id are rows of their own, an anchor row is only
not its own partner; shorter vectors are padded with zeros; components beyond 64
bits saturate and products beyond 64 bits wrap; an anchor without positives, or a
window without negatives, has no rows; empty tables give an empty result; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.llm.frames import cut_lineage

ROW_BLOCK, ANCHOR_BLOCK = 16_384, 1_024  # vectors of a block, on average
CELLS = 1 << 21  # scores held at a time
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_KEY = struct.Struct(">QQBQQ")
_BIAS, _ALL = 1 << 63, (1 << 64) - 1


def vectors(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: row (a number of its own), vec_id, label (relabelled) and v (whole numbers)."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("x", lambda e: F.floor(e * 256.0).cast("long"))
    return rows.select("vec_id", label.alias("label"), whole.alias("v")).withColumn("row", F.monotonically_increasing_id())


def _matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), kind)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
    return out


class _Block:
    """A block of rows against a block of anchors, scored a few anchors at a time."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, width: int, exact: bool):
        kind = np.float64 if exact else np.int64  # products of whole numbers below 2**53 are exact in doubles, and much faster
        self.rows, self.anchors = rows, anchors
        self.r, self.a = _matrix(rows["v"], width, kind), _matrix(anchors["v"], width, kind)
        self.label, self.row = rows["label"].to_numpy(), rows["row"].to_numpy()
        self.no_id = np.asarray(rows["vec_id"].combine_chunks().is_null())
        self.id = rows["vec_id"].fill_null(0).to_numpy()
        self.anchor_label, self.anchor_row = anchors["label"].to_numpy(), anchors["row"].to_numpy()

    def scores(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(anchors, scores, same label) of consecutive anchors."""
        step = max(1, CELLS // max(1, len(self.r)))
        for lo in range(0, len(self.a), step):
            part = slice(lo, lo + step)
            with np.errstate(over="ignore"):
                yield part, (self.a[part] @ self.r.T).astype(np.int64), self.anchor_label[part, None] == self.label[None, :]

    def best(self, score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) places of the k first allowed rows of each anchor: higher scores, then smaller ids."""
        low = np.where(allowed, score, np.iinfo(np.int64).min)
        if low.shape[1] > k:
            least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            allowed = allowed & (low >= least[:, None])
        a, r = np.nonzero(allowed)
        order = np.lexsort([self.row[r], self.id[r], self.no_id[r], -score[a, r], a])
        a, r = a[order], r[order]
        first = np.arange(len(a)) - np.searchsorted(a, a, side="left") < k
        return a[first], r[first]

    def emit(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
        a, r, s = (np.concatenate([x[i] for x in found]).astype(np.int64) if found else np.zeros(0, np.int64) for i in range(3))
        columns = [self.anchors["row"].take(pa.array(a)), self.anchors["vec_id"].take(pa.array(a)), pa.array(s), self.rows["vec_id"].take(pa.array(r)), self.rows["row"].take(pa.array(r))]
        return pa.table(columns, ["anchor", "anchor_id", "score", "vec_id", "row"])


_EMITTED = "anchor long, anchor_id long, score long, vec_id long, row long"


def window_floor(p: np.ndarray) -> np.ndarray:
    """The least score s with 80 * p <= 100 * s."""
    return p - p // 5


def _deal(rows: DataFrame, anchors: DataFrame, n_row: int, n_anchor: int):
    """Rows and anchors grouped by pairs of blocks, each side sent to every block of the other."""
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("rb", block(n_row)).withColumn("ab", every(n_anchor))
    right = anchors.withColumn("ab", block(n_anchor)).withColumn("rb", every(n_row))
    return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab"))


def _pack(anchor: int, score: int, negative: int, vec_id: int | None, row: int) -> bytes:
    return _KEY.pack(anchor, _ALL - (score + _BIAS), 2 * negative + (vec_id is None), (vec_id or 0) + _BIAS, row)


def _partition(key: bytes) -> int:
    return (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 & _ALL) >> 32


def open_windows(pairs: Iterable[tuple[bytes, int]], per_window: int) -> Iterator[tuple]:
    """Rows of SCHEMA from sorted (key, anchor id) pairs; holds the open windows of one anchor only."""
    current, windows = None, []
    for key, anchor_id in pairs:
        anchor, score, kind, vec_id, _ = _KEY.unpack(key)
        score, vec_id = _ALL - score - _BIAS, None if kind & 1 else vec_id - _BIAS
        if anchor != current:
            current, windows = anchor, []
        if kind < 2:
            windows.append([vec_id, score, score - score // 5, 0])
            continue
        windows = [w for w in windows if w[3] < per_window and score >= w[2]]
        for w in windows:
            w[3] += 1
            yield anchor_id, w[0], w[3], vec_id, w[1], score


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, per_window: int = 5, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its first positives, the first different-label rows
    with 80 * positive_score <= 100 * negative_score <= 100 * positive_score, as rows of SCHEMA."""
    spark = embeddings.sparkSession
    rows = cut_lineage(vectors(embeddings), "vectors")
    is_anchor = F.col("vec_id") % every == 0
    size = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(is_anchor, 1)).alias("anchors"), F.max(F.size("v")).alias("width"),
        F.max(F.greatest(F.abs(F.array_max("v").cast("double")), F.abs(F.array_min("v").cast("double")))).alias("largest"),
    ).first()
    if not size["anchors"]:
        return spark.createDataFrame([], SCHEMA)
    width, exact = size["width"], size["width"] * (size["largest"] or 0.0) ** 2 < 2.0**53
    n_row, n_anchor = -(-size["rows"] // row_block), -(-size["anchors"] // anchor_block)
    anchors = rows.where(is_anchor).toDF(*rows.columns)  # columns of its own, for the join with all rows

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        block, found = _Block(left, right, width, exact), []
        for part, score, same in block.scores():
            a, r = block.best(score, same & (block.anchor_row[part, None] != block.row[None, :]), positives)
            found.append((a + part.start, r, score[a, r]))
        return block.emit(found)

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        block, found = _Block(left, right, width, exact), []
        tops = right["tops"].to_pylist()
        for part, score, same in block.scores():
            keys = [np.zeros(0, np.int64)]
            for j in range(positives):  # the j-th positive of every anchor
                has = np.array([len(t) > j for t in tops[part]])
                p = np.array([t[j] if len(t) > j else 0 for t in tops[part]], np.int64)[:, None]
                a, r = block.best(score, ~same & has[:, None] & (score <= p) & (score >= window_floor(p)), per_window)
                keys.append(a * len(block.r) + r)
            a, r = np.divmod(np.unique(np.concatenate(keys)), max(1, len(block.r)))
            found.append((a + part.start, r, score[a, r]))
        return block.emit(found)

    best = _deal(rows, anchors, n_row, n_anchor).applyInArrow(near, _EMITTED)
    rank = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row"))
    best = cut_lineage(best.withColumn("rank", rank).where(F.col("rank") <= positives).drop("rank"), "positives")
    tops = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("tops"))  # 5 of an anchor at most
    within = _deal(rows, anchors.join(tops, "row"), n_row, n_anchor).applyInArrow(windows, _EMITTED)

    pairs = best.withColumn("negative", F.lit(0)).unionByName(within.withColumn("negative", F.lit(1)))
    keyed = pairs.select("anchor", "anchor_id", "score", "negative", "vec_id", "row").rdd.map(lambda p: (_pack(p[0], p[2], p[3], p[4], p[5]), p[1]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionAndSortWithinPartitions(parts, _partition)
    return spark.createDataFrame(dealt.mapPartitions(lambda part: open_windows(part, per_window)), SCHEMA)
