"""Toxicity by multiple-instance learning.

A document is a bag of sentences (cut at ``. ! ?`` and line ends).  A sentence's
score is a logistic function of the features of its words: the lower-cased word
and its first four and five bytes, hashed to ``BUCKETS`` weights.  A
document is toxic if any of its sentences is, so its score is the noisy-or of
theirs.  Only documents have labels; gradients of the noisy-or tell which
sentences the label is about.  Fitted in numpy on a bounded sample of labelled
rows (``most`` of each class), features that stand in fewer than ``least``
documents of the sample left out.

Scoring and ``sentences`` (which locates the offending ones) read whole texts on
the executors.  Null and empty texts have no sentence and get the score 0.
Without positive labels every score stays near 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.labelled import training_sample

BITS = 18
BUCKETS = 1 << BITS
PREFIXES = (4, 5)
_WORD = np.zeros(256, dtype=bool)
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 13, 33, 46, 63]] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def instances(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences (start, end, first sentence per text) and features: per word its sentence and a row of buckets."""
    lower = B.LOWER[data]
    s_start, s_end, s_first = B.runs(~_STOP[data], offsets)
    w_start, w_end, _ = B.runs(_WORD[data], offsets)
    sentence = np.searchsorted(s_start, w_start, side="right") - 1
    hashes = B.span_hasher(lower)
    parts = [hashes(w_start, w_end)]
    parts += [hashes(w_start, np.minimum(w_start + n, w_end)) * np.uint64(0x9E3779B97F4A7C15 + 2 * n) for n in PREFIXES]
    buckets = np.stack([(h >> np.uint64(64 - BITS)).astype(np.int64) for h in parts], axis=1)
    return s_start, s_end, s_first, sentence, buckets


def sentence_scores(model: Model, n: int, sentence: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    logit = np.bincount(sentence, model.weights[buckets].sum(axis=1), n) + model.bias
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], weight: dict[int, float], least: int = 6, epochs: int = 20, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Model:
    """bags: (label, sentence of each word, buckets of each word).

    AdaGrad steps over the bags; an untoxic bag whose sentences all score low has nothing to teach and is passed over."""
    weights = np.zeros(BUCKETS)
    seen = np.zeros(BUCKETS, np.int64)
    for _, _, buckets in bags:
        seen[np.unique(buckets)] += 1
    used = seen >= least
    total = sum(buckets.size for _, _, buckets in bags)
    words, places, features = np.empty(total, np.uint16), np.empty(total, np.int32), np.empty(total, np.int32)  # few large arrays: the driver gives them back
    ready, n, m = [], 0, 0
    for y, sentence, buckets in bags:
        word, column = np.nonzero(used[buckets])
        if len(word):
            flat, at = np.unique(buckets[word, column], return_inverse=True)
            here, known = slice(n, n + len(word)), slice(m, m + len(flat))
            words[here], places[here], features[known] = sentence[word], at.ravel(), flat
            ready.append((y, words[here], features[known], places[here], int(sentence[-1]) + 1))
            n, m = here.stop, known.stop
    bias, squares, bias_square = -7.0, np.full(BUCKETS, 1e-2), 1.0
    rng = np.random.default_rng(seed)
    mean = sum(weight[y] for y, *_ in ready) / max(1, len(ready))
    for _ in range(epochs):
        for i in rng.permutation(len(ready)):
            y, sentence, flat, at, n = ready[i]
            logit = np.bincount(sentence, weights[flat][at], n) + bias
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            none = np.exp(np.log1p(-np.minimum(p, 1 - 1e-9)).sum())  # chance that no sentence is toxic
            if not y and none > 0.98 or y and none < 1e-4:
                continue
            slope = p * (none / max(1 - none, 1e-9)) if y else -p
            slope *= weight[y] / mean
            grad = np.clip(np.bincount(at, slope[sentence], len(flat)) - decay * weights[flat], -1, 1)
            squares[flat] += grad * grad
            weights[flat] += rate * grad / np.sqrt(squares[flat])
            slope_all = float(np.clip(slope.sum(), -1, 1))
            bias_square += slope_all**2
            bias = min(-5.0, bias + 0.05 * slope_all / bias_square**0.5)
    return Model(weights.astype(np.float32), bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, most: int = 5000, most_bytes: int = 1 << 16) -> Model:
    """Fit on at most about ``most`` labelled rows of each class, held-out fold excluded."""
    sample, weight = training_sample(docs, labels, label, folds, fold, most, most_bytes)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                _, _, at = B.runs(_WORD[part], offs)
                texts = [zlib.compress(part[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
                columns = [batch.column(c).slice(lo, hi - lo) for c in ("_id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(at), pa.int64()), pa.array(texts, pa.binary())], ["_id", "label", "words", "text"])

    found = sample.mapInArrow(bags, "_id long, label int, words long, text binary").toArrow()  # bounded by ``most`` and ``most_bytes``
    order = pc.sort_indices(found, sort_keys=[("_id", "ascending"), ("text", "ascending")]).to_pylist()
    size, label_of = found["words"].to_pylist(), found["label"].to_pylist()
    sentence, buckets = np.empty(sum(size), np.uint16), np.empty((sum(size), 1 + len(PREFIXES)), np.int32)
    rows, n = [], 0
    for i in order:
        part = np.frombuffer(zlib.decompress(found["text"][i].as_buffer()), np.uint8)
        here = slice(n, n + size[i])
        _, _, _, sentence[here], buckets[here] = instances(part, np.array([0, len(part)]))
        rows.append((label_of[i], sentence[here], buckets[here]))
        n = here.stop
    return train(rows, weight)


def _scores(m: Model, column: pa.Array) -> np.ndarray:
    data, offsets = B.text_bytes(column)
    scores = np.zeros(len(offsets) - 1)
    for lo, hi, part, offs in B.slices(data, offsets):
        s_start, _, s_first, sentence, buckets = instances(part, offs)
        p = sentence_scores(m, len(s_start), sentence, buckets)
        p[np.bincount(sentence, minlength=len(p)) == 0] = 0  # no word, no score
        none = np.concatenate(([0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))))
        scores[lo:hi] = 1 - np.exp(np.minimum(0.0, none[s_first[1:]] - none[s_first[:-1]]))
    return scores


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(shared.value, batch.column("text")))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def clean(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """The rows that score below ``limit``, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column("text")) < limit))

    return docs.mapInArrow(run, docs.schema)


def sentences(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """Offending sentences: (doc_id, start, length, sentence, score), places in bytes of the UTF-8 text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, _, part, offs in B.slices(data, offsets):
                s_start, s_end, _, sentence, buckets = instances(part, offs)
                p = sentence_scores(m, len(s_start), sentence, buckets)
                rows = []
                for s in np.flatnonzero((p >= least) & (np.bincount(sentence, minlength=len(p)) > 0)):
                    i = int(np.searchsorted(offs, s_start[s], side="right")) - 1
                    rows.append((ids[lo + i], int(s_start[s] - offs[i]), int(s_end[s] - s_start[s]), part[s_start[s] : s_end[s]].tobytes().decode(), float(p[s])))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "length", "sentence", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, length long, sentence string, score double")
