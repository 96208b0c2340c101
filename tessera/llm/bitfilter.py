"""A Bloom filter over 64-bit hashes, built by Spark aggregation, of a size that has a fixed bound.

It only spares later joins rows: whatever it lets pass is joined exactly. When more hashes are added
than it is meant for, it lets more pass, up to everything. Nulls are left out, repeats change nothing, and a
filter of nothing lets nothing pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**28 bits are 32 MB, the most that is broadcast.
MOST_BITS = 28
#: Words that a row holds on their way to the driver.
PIECE = 1 << 16


def build(hashes: DataFrame, column: str = "h") -> np.ndarray:
    """Words of the filter of all values of a long column; the driver gets them once, in pieces of PIECE words."""
    hashes = hashes.select(F.col(column).alias("h")).where("h is not null")
    power = min(MOST_BITS, max(16, (16 * hashes.count()).bit_length()))
    mask = F.lit((1 << power) - 1)
    places = hashes.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits"))
    n = 1 << (power - 6)
    piece = min(PIECE, n)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at, bits = batch.column("at").to_numpy(), batch.column("bits").to_numpy()
            for k in np.unique(at // piece).tolist():
                of = at // piece == k
                held.setdefault(k, np.zeros(piece, np.int64))[at[of] % piece] = bits[of]
        for k, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([v.tobytes()], pa.binary())], names=["k", "v"])

    dealt = words.repartition(n // piece, F.floor(F.col("at") / piece))
    out = np.zeros(n, np.uint64)
    for row in dealt.mapInArrow(pieces, "k long, v binary").toLocalIterator():
        out[row["k"] * piece : (row["k"] + 1) * piece] |= np.frombuffer(row["v"], np.uint64)
    return out


def passing(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(words) * 64 - 1)
    out = np.ones(len(h), bool)
    for p in (h & mask, (h >> np.uint64(32)) & mask):
        out &= (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out
