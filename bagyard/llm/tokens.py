"""Whole-text encoding with the ``tokenizers`` library inside Spark tasks.

The library merges the letters of every word anew, and words repeat.
``PieceEncoder`` cuts texts only where the tokenizers of this kind always cut
- before a single space between two non-space characters, and between a letter
and a following ASCII character that is no letter -, has the library encode
each distinct piece once per worker, and lays the ids end to end.  Pieces are
known by a 64-bit hash and their length.  ``tests/llm/test_tokens.py`` compares
the result with plain whole-text encoding.  A text that holds the string of a
special token is encoded whole, as the library does by default.  The table of
pieces is bounded by ``max_pieces``; a full one is emptied.

Null texts count as empty texts.
"""

from __future__ import annotations

import os

import numpy as np

from bagyard.llm import textbytes as B

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LATIN = np.zeros(256, dtype=bool)  # second byte of the letters À to ÿ, whose first byte is C3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_ASCII_MARK = np.zeros(256, dtype=bool)  # ASCII without letters
_ASCII_MARK[:128] = ~_LETTER[:128]
_PLAIN = np.zeros(256, dtype=bool)  # ASCII that no tokenizer takes for white space
_PLAIN[33:127] = True

_ENCODERS: dict[tuple[str, int], "PieceEncoder"] = {}


def encoder(path: str, max_pieces: int = 1 << 20) -> "PieceEncoder":
    """The worker's encoder of a vocabulary file, made once per process."""
    key = (path, max_pieces)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, max_pieces)
    return _ENCODERS[key]


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions at which a piece begins, as flags; the first byte of a text is the caller's to add."""
    n = len(data)
    flag = np.zeros(n, dtype=bool)
    if n < 2:
        return flag
    prev, here = data[:-1], data[1:]
    after_latin = np.zeros(n - 1, dtype=bool)  # the character before is a letter À to ÿ
    after_latin[1:] = (data[:-2] == 0xC3) & _LATIN[prev[1:]]
    after_letter = _LETTER[prev] | after_latin
    flag[1:] = after_letter & _ASCII_MARK[here]
    # a space between two characters that are surely no white space
    space = np.flatnonzero(data[1 : n - 1] == 32) + 1
    if len(space):
        left = _PLAIN[data[space - 1]] | after_latin[space - 1]
        right = _PLAIN[data[space + 1]] | (data[space + 1] == 0xC3)
        flag[space[left & right]] = True
        # any other space is not cut at, unless a letter stands before it
    return flag


class PieceEncoder:
    def __init__(self, path: str, max_pieces: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = "Lowercase" in repr(self.tokenizer.normalizer)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bits = max(4, int(2 * max_pieces - 1).bit_length())
        self.max_pieces = max_pieces
        # a digit stands alone between two words of letters: its id marks where one word ends
        mark = self.tokenizer.encode("a 0 a", add_special_tokens=False).ids[1:-1]
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        size = 1 << self.bits
        self.keys = np.zeros(size, dtype=np.uint64)
        self.at = np.zeros(size, dtype=np.int64)
        self.count = np.zeros(size, dtype=np.int64)
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = self.held = 0

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or of the free slot where it belongs."""
        last = np.int64(len(self.keys) - 1)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.flatnonzero((self.keys[slot] != h) & (self.keys[slot] != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & last
            got = self.keys[slot[todo]]
            todo = todo[(got != h[todo]) & (got != 0)]
        return slot

    def _encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        simple = [i for i, p in enumerate(pieces) if p[:1] == b" " and p[1:].isalpha()] if self.mark is not None else []
        for at in range(0, len(simple), 64):
            part = simple[at : at + 64]
            ids = self.plain([" 0".join(pieces[i].decode() for i in part)])[0]
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(part) - 1:
                for i, a, b in zip(part, [-1, *ends], [*ends, len(ids)], strict=True):
                    out[i] = ids[a + 1 : b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.plain([pieces[i].decode() for i in rest]), strict=True):
            out[i] = ids
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> None:
        h, first = np.unique(h, return_index=True)
        raw = data.tobytes()
        made = self._encode_pieces([raw[a:b] for a, b in zip(starts[first], ends[first], strict=True)])
        sizes = np.array([len(x) for x in made], dtype=np.int64)
        total = int(sizes.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        if total:
            self.pool[self.used : self.used + total] = np.concatenate(made)
        at = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.held += len(h)
        todo = np.arange(len(h))
        while len(todo):  # of several that want one free slot the last gets it, the others look again
            slot = self._find(h[todo])
            self.keys[slot] = h[todo]
            won = self.keys[slot] == h[todo]
            self.at[slot[won]], self.count[slot[won]] = at[todo[won]], sizes[todo[won]]
            todo = todo[~won]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts end to end (unsigned 32-bit), and per text where they begin (n + 1 entries)."""
        n = len(offsets) - 1
        whole = self._whole(data, offsets)
        if self.lowers:
            data = B.LOWER[data]
        flag = cuts(data)
        inner = offsets[:-1][np.diff(offsets) > 0]
        flag[inner] = True
        starts = np.flatnonzero(flag)
        ends = np.append(starts[1:], len(data))
        h = B.span_hashes(data, starts, ends) | np.uint64(1)
        if self.held + len(starts) // 4 > self.max_pieces:
            self._clear()
        slot = self._find(h)
        new = np.flatnonzero(self.keys[slot] != h)
        if len(new):
            while self.held + len(new) > len(self.keys) // 2:  # one slice alone may need more room
                self.bits += 1
                self._clear()
                new = np.arange(len(h))
            self._learn(data, starts[new], ends[new], h[new])
            slot = self._find(h)
        at, count = self.at[slot], self.count[slot]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = self.pool[np.repeat(at - before[:-1], count) + np.arange(before[-1])]
        bounds = before[np.searchsorted(starts, offsets, side="left")]
        if whole:
            parts = [ids[bounds[i] : bounds[i + 1]] if i not in whole else whole[i] for i in range(n)]
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            ids = np.concatenate(parts)
        return ids, bounds

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        raw, found = data.tobytes(), {}
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                found[i] = raw[offsets[i] : offsets[i + 1]]
                at = raw.find(s, max(int(offsets[i + 1]), at + 1))
        return dict(zip(found, self.plain([t.decode() for t in found.values()]), strict=True))
