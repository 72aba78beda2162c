"""Sets of word shingles of whole texts, vectorised over Arrow batches.

A-Z are lower-cased, words are runs of characters other than ASCII white space.
A text's set holds its distinct runs of ``k`` words; a text of fewer words has
its whole sequence as the only member, a text without words an empty set.
Members are 64-bit hashes."""

from __future__ import annotations

import numpy as np

from bagyard.llm import textbytes as B


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct members of several texts end to end, and where each text's begin (n + 1 entries)."""
    low = B.LOWER[data]
    starts, ends, first = B.words(low, offsets)
    h = B.span_hashes(low, starts, ends)
    count = np.diff(first)
    windows = B.window_hashes(h, k)
    owner = np.repeat(np.arange(len(count)), count)
    inside = owner[: len(windows)] == owner[k - 1 :][: len(windows)] if len(windows) else np.zeros(0, bool)
    member, text = windows[inside], owner[: len(windows)][inside]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.array([int(B.mix((h[first[i] : first[i + 1]] * _ODD[: count[i]]).sum(keepdims=True) + np.uint64(count[i]))[0]) for i in short], dtype=np.uint64)
        member, text = np.concatenate([member, whole]), np.concatenate([text, short])
    order = np.lexsort((member, text))
    member, text = member[order], text[order]
    keep = np.ones(len(member), bool)
    keep[1:] = (member[1:] != member[:-1]) | (text[1:] != text[:-1])
    member, text = member[keep], text[keep]
    return member, np.searchsorted(text, np.arange(len(offsets)))


_ODD = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
