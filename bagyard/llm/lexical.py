"""op12: ranked lexical search with bag deduplication.

Terms are maximal runs of ASCII letters and digits and of all characters above
U+007F, A-Z lower-cased.  Items are taken in blocks of bounded size; for a block
every whole text is restricted to the block's vocabulary: a vector of
(term, occurrences) beside n, the number of all its terms.  Documents with equal
vectors and equal m get equal scores from every item, so rows are dealt by a hash
of (vector, m), classes are told by the vectors themselves, each class is scored
once, and the best classes of an item are expanded by ascending doc_id.  A class
keeps its k smallest ids, because no list of k documents can hold more of it.

Defined cases: a null text has no terms and does not count; an item with a null
text or without a known term has no rows; rows that repeat a doc_id are documents
of their own, rows that repeat an item_id are items of their own; a null doc_id
comes last among equal scores; empty tables give an empty result; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bagyard.llm.frames import cut_lineage, running
from bagyard.llm.textbytes import LOWER, runs, slices, text_bytes

K = 10
BLOCK_BYTES = 4 << 20  # of item texts: bounds the vocabulary and the item list that every task holds
CELLS = 1 << 21  # of class-by-item scores, and of additions, at a time

TERM = np.zeros(256, dtype=bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased terms of texts laid end to end, and per text the index of its first term (n + 1 entries)."""
    inside = TERM[data]
    starts, ends, first = runs(inside, offsets)
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = LOWER[data[inside]]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(packed)]), first


class Items:
    """A block of items: vocabulary, and for each term its items with the number of repeats."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        found, first = terms(*text_bytes(pa.array(texts, pa.large_string())))
        self.vocabulary = pc.unique(found)
        term = pc.index_in(found, value_set=self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        item = np.repeat(np.arange(len(texts)), np.diff(first))
        key, repeats = np.unique(term * len(texts) + item, return_counts=True)
        self.item, self.repeats = key % max(len(texts), 1), repeats.astype(np.int64)
        self.start = np.searchsorted(key // max(len(texts), 1), np.arange(len(self.vocabulary) + 1))


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """Per document with a term: doc_id, n (all its terms) and vec ((term, occurrences) pairs of 32-bit integers by term)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids = batch.column(0)
            for lo, _, data, offsets in slices(*text_bytes(batch.column(1))):
                found, first = terms(data, offsets)
                n = np.diff(first)
                at = pc.index_in(found, value_set=known)
                hit = np.asarray(pc.is_valid(at))
                doc = np.repeat(np.arange(len(n)), n)[hit]
                key, times = np.unique(doc * (len(known) + 1) + at.drop_null().to_numpy().astype(np.int64), return_counts=True)
                pairs = np.stack([key % (len(known) + 1), times], axis=1).astype("<i4")
                ends = np.searchsorted(key // (len(known) + 1), np.arange(len(n) + 1)) * 8
                vec = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(pairs.tobytes())])
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(n)).take(some), pa.array(n[some].astype(np.int64)), vec.cast(pa.binary()).take(some)], ["doc_id", "n", "vec"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(restrict, "doc_id long, n long, vec binary")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term, occurrences) rows of all vectors, and the index of each vector's first."""
    data, offsets = text_bytes(column)
    return np.frombuffer(data.tobytes(), "<i4").reshape(-1, 2).astype(np.int64), offsets // 8


def weights(vecs: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """floor(1000 * ln((2 * N + 2) / (2 * df + 1))) by term; counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column(0))[0][:, 0], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    df = np.zeros(size, np.int64)
    for row in vecs.select("vec").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a vocabulary at most
        df[row["term"]] = row["df"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def classes(vecs: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Classes of equal (vec, m): vec, m and members, the k smallest ids of a class in order.

    Ranks are cut in the map tasks too, so a class with a third of all rows sends k rows per task."""
    m = F.expr(f"25 + (75BD * n * {n_docs}BD) div {max(n_terms, 1)}BD").cast("long")
    rows = vecs.where(F.octet_length("vec") > 0).select("doc_id", "vec", m.alias("m")).withColumn("h", F.xxhash64("vec", "m"))
    rank = F.row_number().over(W.partitionBy("h", "vec", "m").orderBy(F.asc_nulls_last("doc_id")))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    return few.groupBy("h", "vec", "m").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("members")).select("vec", "m", F.col("members.doc_id").alias("members"))


def _best(item: np.ndarray, score: np.ndarray, first: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each item: higher scores first, then ids present, then smaller ids."""
    order = np.lexsort([first, missing, -score, item])
    sorted_items = item[order]
    begin = np.searchsorted(sorted_items, sorted_items, side="left")
    return order[np.arange(len(order)) - begin < k]


def score_classes(found: DataFrame, items: Items, weight: np.ndarray, k: int) -> DataFrame:
    """Each task's k best classes of every item: item (place in the block), item_id, score, members."""
    shared = found.sparkSession.sparkContext.broadcast((items, weight))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        size = len(items.ids)
        per_term = np.diff(items.start)
        item, total, first = (np.zeros(0, np.int64) for _ in range(3))
        missing, members = np.zeros(0, bool), []
        least = np.zeros(size, np.int64)  # the k-th best score so far
        for batch in batches:
            pairs, begin = _pairs(batch.column(0))
            m = batch.column(1).to_numpy()
            adds = np.concatenate([[0], np.cumsum(per_term[pairs[:, 0]])])[begin]  # additions before each class
            lo = 0
            while lo < len(m):
                hi = min(int(np.searchsorted(adds, adds[lo] + CELLS, side="right")) - 1, lo + CELLS // size, len(m))
                hi = max(hi, lo + 1)
                part = pairs[begin[lo] : begin[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(begin[lo : hi + 1]))
                gain = weight[part[:, 0]] * ((1_000_000_000 * part[:, 1]) // (1000 * part[:, 1] + 8 * m[lo:hi][row]))
                n = per_term[part[:, 0]]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(items.start[part[:, 0]], n)
                cells = np.zeros((hi - lo) * size, np.int64)
                np.add.at(cells, np.repeat(row * size, n) + items.item[place], np.repeat(gain, n) * items.repeats[place])
                cells = cells.reshape(hi - lo, size)
                at, which = np.nonzero((cells > 0) & (cells >= least))
                ids = batch.column(2).slice(lo, hi - lo)
                heads = pc.list_element(ids, 0)
                head, none = heads.fill_null(0).to_numpy(), np.asarray(heads.is_null())
                old = len(item)
                item, total = np.concatenate([item, which]), np.concatenate([total, cells[at, which]])
                first, missing = np.concatenate([first, head[at]]), np.concatenate([missing, none[at]])
                best = _best(item, total, first, missing, k)
                members = [members[i] if i < old else ids[int(at[i - old])].as_py() for i in best]
                item, total, first, missing = item[best], total[best], first[best], missing[best]
                full = np.flatnonzero(np.bincount(item, minlength=size) >= k)
                least[full] = total[np.searchsorted(item, full, side="right") - 1]  # of an item, the worst stands last
                lo = hi
        if len(item):
            ids = pa.array([items.ids[i] for i in item], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(item), ids, pa.array(total), pa.array(members, pa.list_(pa.int64()))], ["item", "item_id", "score", "members"])

    return found.mapInArrow(score, "item long, item_id long, score long, members array<long>")


def _blocks(items: DataFrame, most: int) -> tuple[DataFrame, list[int]]:
    """Items with a text, in blocks whose texts have ``most`` bytes and one more item at most."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).withColumn("size", F.octet_length("text").cast("long") + 1)
    rows = running(rows, [F.col("item_id"), F.col("text")], {"upto": F.col("size")})
    rows = cut_lineage(rows.select("item_id", "text", F.expr(f"(upto - size) div {most}").alias("block")), "items")
    return rows, sorted(r["block"] for r in rows.select("block").distinct().collect())  # one number for every 4 MB of items


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    vecs = cut_lineage(vectors(docs, items), "vectors")
    n_docs, n_terms = vecs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    best = score_classes(classes(vecs, n_docs, n_terms, k), items, weights(vecs, n_docs, len(items.vocabulary)), k)
    by_class = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last(F.get("members", F.lit(0))))
    best = best.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k)
    hits = best.select("item", "item_id", "score", F.explode("members").alias("doc_id"))
    by_doc = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(by_doc)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of each item with a score above 0: item_id, rank, doc_id, score."""
    rows, blocks = _blocks(items, block_bytes)
    found = []
    for block in blocks:
        texts = rows.where(F.col("block") == block).orderBy("item_id", "text").collect()  # bounded by block_bytes
        found.append(_search_block(docs, Items([r["item_id"] for r in texts], [r["text"] for r in texts]), k))
    if not found:
        schema = T.StructType.fromDDL("item_id long, rank int, doc_id long, score long")
        return docs.sparkSession.createDataFrame([], schema)
    return functools.reduce(DataFrame.unionByName, found)
