"""Vectorised work on the UTF-8 bytes of whole texts, in bounded slices of Arrow batches.

All helpers take the bytes of several texts laid end to end and ``offsets``
(one more entry than texts).  A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # a slice ends at the first text that passes this size; a longer text is a slice by itself

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, 2 * SLICE_BYTES)
    made = []
    for base in (_PRIME, _INVERSE):
        a = np.full(size, base, dtype=np.uint64)
        a[0] = 1
        made.append(np.multiply.accumulate(a))
    if size <= 4 * SLICE_BYTES:  # tables of longer texts are not kept
        _POWERS[:] = made
    return made[0][:n], made[1][:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of consecutive slices of about ``most`` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="left"))
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """64-bit hashes of spans (starts, ends) of bytes; equal spans have equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return lambda starts, ends: mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hasher(data)(starts, ends)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags, cut at the ends of texts: start, end, and per text the index of its first run (n + 1 entries)."""
    step = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = step[0::2], step[1::2]
    cuts = offsets[1:-1]
    if len(cuts) and len(starts):
        at = np.searchsorted(starts, cuts, side="left") - 1
        over = (at >= 0) & (ends[np.maximum(at, 0)] > cuts)
        extra = np.unique(cuts[over])
        if len(extra):
            starts, ends = np.sort(np.concatenate([starts, extra])), np.sort(np.concatenate([ends, extra]))
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than ASCII white space): start, end, and per text the index of its first word (n + 1 entries)."""
    return runs(~SPACE[data], offsets)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (len - k + 1 entries); runs over text ends are the caller's to drop."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[k:] - total[:n]) * down[:n] + np.uint64(k))
