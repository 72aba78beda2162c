"""Quality classifier: supervised subword embeddings.

Every word, every pair of neighbouring words and every run of three and of four
characters (code points) of a text is hashed to one of ``BUCKETS`` vectors, pairs
of two equal words all to the same one; a document is the mean of its vectors, a softmax layer gives the class.  Vectors and layer are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled rows (``most`` of each class).

Scoring reads whole texts on the executors: the layer is linear, so the mean of
the vectors times the layer is the mean of one number per bucket, and a batch of
texts is scored by lookups and running sums.

Null and empty texts have no features and get the score of the layer's bias.
Without labels every score is 0.5; with a single class the bias learns it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.labelled import training_sample

BITS = 17
BUCKETS = 1 << BITS
SAME = np.uint64(0x5851F42D4C957F2D)  # hash of all pairs of equal words
LAYER_NORM = 16.0  # the layer is scaled back to this norm, so that no rate lets the steps grow without end


@dataclass
class Model:
    per_bucket: np.ndarray  # what a feature adds to the difference of the two logits
    bias: float


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of each character as one number, and its text."""
    begins = (data & 0xC0) != 0x80
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, len(data)))
    code = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        code[more] = (code[more] << np.uint32(8)) | data[at[more] + k]
    return code, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets)))


def _grams(code: np.ndarray) -> list[np.ndarray]:
    """Buckets of the runs of three and four characters that begin at each character."""
    out, h = [], code * np.uint32(0x01000193)
    for n in (2, 3, 4):
        h = (h[:-1] ^ code[n - 1 :]) * np.uint32(0x01000193)
        if n > 2:
            out.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + n * 2) >> np.uint32(32 - BITS)).astype(np.int64))
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text of each) for words, pairs of words, and runs of three and four characters of several texts."""
    starts, ends, first = B.words(data, offsets)
    key = B.span_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    found = [((key >> np.uint64(64 - BITS)).astype(np.int64), owner)]
    pair = np.where(key[:-1] == key[1:], SAME, B.mix(key[:-1] + B.mix(key[1:])))[owner[1:] == owner[:-1]]
    found.append(((pair >> np.uint64(64 - BITS)).astype(np.int64), owner[1:][owner[1:] == owner[:-1]]))
    code, text = _characters(data, offsets)
    for n, g in zip((3, 4), _grams(code) if len(code) >= 4 else [], strict=False):
        within = text[: len(g)] == text[n - 1 :][: len(g)]
        found.append((g[within], text[: len(g)][within]))
    return found


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], weight: dict[int, float], dim: int = 8, steps: int = 24_000, rate: float = 1.0, seed: int = 3) -> Model:
    """Stochastic gradient descent over (label, buckets, counts) rows, ``steps`` at a falling rate: the fewer the rows, the more often each."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, dim)) - 0.5) / dim).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    total = sum(weight[y] for y, _, _ in rows)
    prior = np.array([max(1e-3, sum(weight[y] for y, _, _ in rows if y == k) / total) for k in (0, 1)])
    bias += np.log(prior).astype(np.float32)
    mean = total / len(rows)
    epochs = -(-steps // len(rows))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            y, buckets, counts = rows[i]
            share = (counts / max(1, counts.sum())).astype(np.float32)
            hidden = share @ vectors[buckets]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            p *= step * min(weight[y] / mean, 4.0)
            back = p @ layer
            layer -= np.outer(p, hidden)
            layer *= min(1.0, LAYER_NORM / max(1e-9, float(np.sqrt(np.square(layer).sum()))))
            bias -= 0.1 * p
            vectors[buckets] -= (share * len(share))[:, None] * back / max(1.0, np.sqrt(len(share)))
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, most: int = 2000, most_bytes: int = 1 << 16) -> Model:
    """Fit on at most about ``most`` labelled rows of each class, held-out fold excluded."""
    sample, weight = training_sample(docs, labels, label, folds, fold, most, most_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y = batch.column("_id").to_pylist(), batch.column("label").to_pylist()
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                buckets, texts = (np.concatenate(x) for x in zip(*features(part, offs), strict=True))
                keys, n = np.unique(texts * BUCKETS + buckets, return_counts=True)
                cut = np.searchsorted(keys // BUCKETS, np.arange(hi - lo + 1))
                keys, n = (keys % BUCKETS).astype("<u4"), n.astype("<u4")
                rows = [(ids[i], y[i], keys[a:b].tobytes(), n[a:b].tobytes()) for i, a, b in zip(range(lo, hi), cut[:-1], cut[1:], strict=True)]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["_id", "label", "buckets", "counts"])

    found = sample.mapInArrow(count, "_id long, label int, buckets binary, counts binary").collect()  # bounded by ``most``
    found.sort(key=lambda r: (r["_id"], r["buckets"]))
    rows = [(r["label"], np.frombuffer(r["buckets"], "<u4"), np.frombuffer(r["counts"], "<u4")) for r in found]
    return train(rows, weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = B.text_bytes(batch.column("text"))
            scores = np.zeros(len(offsets) - 1)
            for lo, hi, part, offs in B.slices(data, offsets):
                total, n = np.zeros(hi - lo), np.zeros(hi - lo)
                for buckets, texts in features(part, offs):
                    total += np.bincount(texts, m.per_bucket[buckets], hi - lo)
                    n += np.bincount(texts, minlength=hi - lo)
                scores[lo:hi] = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + m.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
