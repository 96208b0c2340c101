"""Cut texts where byte-level BPE surely cuts them, and encode every distinct chunk only once.

The byte-level pattern never matches across these places: before white space that follows another
character; after a letter that another ASCII character follows; after a lone line feed. Texts are
cut there, so a chunk's ids don't depend on what stands around it. Nulls and empty texts have no chunks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from .textkernel import expand, raw_bytes, span_hashes

#: Lead bytes of characters that some library may take for white space: no cut after a line feed before them.
_RISKY = np.zeros(256, dtype=bool)
_RISKY[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_RISKY3 = _RISKY.copy()
_RISKY3[0xC2] = False
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_BREAK = np.zeros(256, dtype=bool)  # white space for every library
_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each chunk, and each text's first chunk."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begin = np.zeros(n, bool)
    letter, gap = _LETTER[data], _BREAK[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[1:] >= 0x80)  # U+00C0 .. U+00FF
    begin[1:] = letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
    at = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    wide = data[at - 1] >= 0x80
    begin[at] = (data[at - 1] > 0x20) & ~(wide & ((data[at - 2] == 0xC2) | _RISKY3[data[at - 3]]))  # a look across a text's start only loses a cut
    feed = at[(at < n - 1) & (data[at] == 0x0A)]
    feed = feed[begin[feed] & (data[np.minimum(feed + 1, n - 1)] > 0x20) & ~_RISKY[data[np.minimum(feed + 1, n - 1)]]]
    begin[feed + 1] = True
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(begin)
    end = np.append(start[1:], n)
    return start, end, np.searchsorted(start, offsets)


class Cache:
    """From 64-bit hashes of chunks to their ids, in sorted levels that merge as they grow.

    A second hash tells entries apart whose first ones are equal. Beyond limit entries or values, the
    entries that weren't found again since the last time go, and of the others the oldest.
    """

    def __init__(self, limit: int, kind: type = np.int32, values: int = 1 << 23) -> None:
        self.limit, self.kind, self.values = limit, kind, values
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.start, self.size, self.check, self.hit = (np.zeros(1 << 12, k) for k in (np.int64, np.int32, np.uint64, bool))
        self.flat = np.zeros(1 << 14, kind)
        self.entries = self.used = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for known, entry in self.levels:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = (known[at] == keys) & (self.check[entry[at]] == checks)
            out[hit] = entry[at[hit]]
        self.hit[out[out >= 0]] = True
        return out

    def make_room(self, k: int) -> None:
        """To be called before find, so that entries stay where they are until they are read."""
        if self.entries + k <= self.limit and self.used <= self.values:
            return
        kept = np.flatnonzero(self.hit[: self.entries])[-(self.limit // 2) :]
        newest = np.cumsum(self.size[kept[::-1]], dtype=np.int64)
        kept = kept[len(kept) - int(np.searchsorted(newest, self.values // 2, "right")) :]
        place = np.full(self.entries, -1, np.int64)
        place[kept] = np.arange(len(kept))
        keys, entry = (np.concatenate([x[i] for x in self.levels]) if self.levels else np.zeros(0, k) for i, k in enumerate((np.uint64, np.int64)))
        keys, entry = keys[place[entry] >= 0], place[entry[place[entry] >= 0]]
        order = np.argsort(keys, kind="stable")
        self.levels = [(keys[order], entry[order])] if len(keys) else []
        size = self.size[kept]
        self.flat = self.flat[expand(self.start[kept], size)]
        self.start, self.size, self.check, self.hit = np.cumsum(size, dtype=np.int64) - size, size, self.check[kept], np.zeros(len(kept), bool)
        self.entries, self.used = len(kept), len(self.flat)

    @staticmethod
    def _room(a: np.ndarray, need: int) -> np.ndarray:
        return a if need <= len(a) else np.concatenate([a, np.zeros(max(need, len(a) * 3 // 2) - len(a), a.dtype)])

    def add(self, keys: np.ndarray, checks: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Store sorted new keys; returns their entries."""
        k, n = len(keys), len(flat)
        self.start, self.size, self.check, self.hit = (self._room(x, self.entries + k) for x in (self.start, self.size, self.check, self.hit))
        self.flat = self._room(self.flat, self.used + n)
        entry = np.arange(self.entries, self.entries + k)
        self.start[entry] = self.used + np.cumsum(sizes) - sizes
        self.size[entry], self.check[entry], self.hit[entry] = sizes, checks, False
        self.flat[self.used : self.used + n] = flat
        self.entries, self.used = self.entries + k, self.used + n
        self.levels.append((keys, entry))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * 2 >= len(self.levels[-2][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, ids = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.argsort(both, kind="stable")
            self.levels.append((both[order], ids[order]))
        return entry

    def ids(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the entries, and their ids in a row."""
        size = self.size[entry]
        return size, self.flat[expand(self.start[entry], size)]

    def through(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and values of all spans of data; make gives those of some spans, each kind of which is asked for once."""
        keys, at, inverse = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        checks = span_hashes(data, start[at], end[at], 11)
        self.make_room(len(keys))
        entry = self.find(keys, checks)
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self.add(keys[new], checks[new], *make(at[new]))
        return self.ids(entry[inverse])


def encode(texts: pa.Array, cache: Cache, encoder: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in a row, and each text's first. encoder(data, start, end) gives sizes and ids of chunks."""
    data, offsets = raw_bytes(texts)
    start, end, first = cut(data, offsets)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    sizes, ids = cache.through(data, start, end, lambda of: encoder(data, start[of], end[of]))
    before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return ids, before[first]


def gathered(parts: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray, kind: type = np.int32) -> np.ndarray:
    """Values of rows of these sizes in a row, from parts: (which rows, their values in a row)."""
    flat = np.zeros(int(sizes.sum()), kind)
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    for which, values in parts:
        flat[expand(begin[which], sizes[which])] = values
    return flat


def joinable(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that may be written one after another: ' x...y'; and those that may if a line feed goes before: 'x...y'."""
    longer, closed = end - start > 1, _PLAIN[data[end - 1]]
    spaced = longer & closed & (data[start] == 0x20) & _PLAIN[data[np.minimum(start + 1, len(data) - 1)]]
    return spaced, closed & _PLAIN[data[start]]
