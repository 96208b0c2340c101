"""Vectorised work on the bytes of many texts at once: words, hashes of words, windows of words.

A word's hash is a polynomial over random 64-bit byte codes modulo 2**64, taken from prefix sums
and finished with a bijective mixer, so that equal words have equal hashes everywhere. Two seeds
give 128 bits where a hash stands for the words themselves.

A null text is an empty one and has no words; no texts at all give empty arrays; equal texts give equal
values wherever they stand.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U = np.uint64
#: Separators of words: space and \x09-\x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=8)
def _codes(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """P**j and P**-j modulo 2**64 for j below size, P odd; one pair of tables serves all seeds."""
    p = 0x9FB21C651E98DF25
    out = []
    for base in (p, pow(p, -1, 2**64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(size).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (Stafford's variant 13 of the 64-bit finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and each text's offsets; null is empty."""
    if texts.null_count:
        texts = pa.compute.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a slice of documents; doc is each word's row, first[d] .. first[d+1] are row d's words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int = 1) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end, seed)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    if not len(start):
        return np.zeros(0, U)
    p, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_codes(seed)[data] * p[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words [^\\x20\\x09-\\x0D]+ of each text; lower: A-Z become a-z first."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    if not n:
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    full = ~_SPACE[data]
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] |= full[inner]
    ends = full.copy()
    ends[:-1] &= ~full[1:]
    ends[inner - 1] |= full[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def window_hashes(h: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hash of each run of width consecutive entries of h (rows are not told apart here)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    p, inverse = powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, U)
    np.cumsum(h * p[: len(h)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * inverse[:n] + U(seed))


def within(first: np.ndarray, width: int) -> np.ndarray:
    """Whether the window that starts at each word stays in its row, for the starts of window_hashes."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    sizes = np.diff(first)
    return (np.repeat(first[1:], sizes)[:n] - np.arange(n)) >= width


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least entry of each window of width entries."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, have = h.copy(), np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        right, right_at = best[step:], at[step:]
        left, left_at = best[:-step], at[:-step]
        less = right < left
        best, at = np.where(less, right, left), np.where(less, right_at, left_at)
        have += step
    return at[:n]


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ..., for lengths[0] entries, then those of starts[1], and so on."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
