"""Simple-8b: a 4-bit selector says how many ids of how many bits share a 64-bit word.

Ids stand in blocks of BLOCK (the last may be shorter), and each block starts at a word of its own,
so blocks are encoded and decoded in lockstep by numpy. An id of more than 60 bits is an escape: a
word of zeros, then the id as a word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
U = np.uint64
#: Selector, ids in a word, bits of an id.
SELECTORS = [(1, 60, 1), (2, 30, 2), (3, 20, 3), (4, 15, 4), (5, 12, 5), (6, 10, 6), (7, 8, 7), (8, 7, 8), (9, 6, 10), (10, 5, 12), (11, 4, 15), (12, 3, 20), (13, 2, 30), (14, 1, 60)]
COUNT = np.zeros(16, np.int64)
for _s, _n, _b in SELECTORS:
    COUNT[_s] = _n
PAD = 60
#: Bit length of small values.
_BITS = np.frexp(np.arange(1 << 20, dtype=np.float64))[1].astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all blocks in a row, and the number of words of each block."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, U), np.zeros(0, np.int64)
    values = np.zeros((blocks, BLOCK + PAD), U)
    full = n // BLOCK
    values[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        values[full, : n - full * BLOCK] = ids[full * BLOCK :]
    flat = values.reshape(-1)
    bits = np.zeros(len(flat) + PAD, np.uint8)
    if int(flat.max()) < len(_BITS):
        bits[: len(flat)] = _BITS[flat]
    else:
        bits[: len(flat)] = [x.bit_length() if x < 1 << 60 else 64 for x in flat.tolist()]
    best = np.zeros(len(flat), np.uint8)  # the selector at each place: the most ids that fit
    most, have = bits.copy(), 1
    widest = {1: bits[: len(flat)]}
    for count in sorted(c for _, c, _ in SELECTORS if c > 1):
        while have < count:
            step = min(have, count - have)
            most[: len(most) - step] = np.maximum(most[: len(most) - step], most[step:])
            have += step
        widest[count] = most[: len(flat)].copy()
    for selector, count, width in reversed(SELECTORS):
        best[widest[count] <= width] = selector
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = n - (blocks - 1) * BLOCK
    base = np.arange(blocks) * (BLOCK + PAD)
    at, words = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    live = np.arange(blocks)
    places, owners, ranks = [], [], []
    while len(live):
        place = base[live] + at[live]
        places.append(place)
        owners.append(live)
        ranks.append(words[live])
        chosen = best[place]
        at[live] += np.maximum(1, COUNT[chosen])
        words[live] += np.where(chosen == 0, 2, 1)
        live = live[at[live] < lengths[live]]
    place, owner, rank = np.concatenate(places), np.concatenate(owners), np.concatenate(ranks)
    where = (np.cumsum(words) - words)[owner] + rank
    out, chosen = np.zeros(int(words.sum()), U), best[place]
    for selector, count, width in SELECTORS:
        of = np.flatnonzero(chosen == selector)
        if len(of):
            word, p = np.full(len(of), U(selector) << U(60)), place[of]
            for k in range(count):
                word |= flat[p + k] << U(width * k)
            out[where[of]] = word
    of = np.flatnonzero(chosen == 0)
    out[where[of] + 1] = flat[place[of]]
    return out, words


def decode(words: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray:
    """The total ids of blocks whose words stand in a row; sizes: words of each block."""
    raw = np.zeros(len(words) + 1, bool)
    escape = words == 0
    raw[1:] = escape
    raw = raw[:-1]
    selector = (words >> U(60)).astype(np.int64)
    count = COUNT[selector]
    count[escape] = 0
    count[raw] = 1
    before = np.concatenate([[0], np.cumsum(count)])
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    block = np.repeat(np.arange(len(sizes)), sizes)
    at = before[:-1] - before[first[:-1]][block]  # place in the block
    out = np.zeros((len(sizes), BLOCK + PAD), U)
    flat, base = out.reshape(-1), block * (BLOCK + PAD) + at
    packed = ~raw & ~escape
    for s, n, width in SELECTORS:
        of = np.flatnonzero(packed & (selector == s))
        if len(of):
            w, mask = words[of], U((1 << width) - 1)
            for k in range(n):
                flat[base[of] + k] = (w >> U(width * k)) & mask
    flat[base[raw]] = words[raw]
    return np.ascontiguousarray(out[:, :BLOCK]).reshape(-1)[:total]
