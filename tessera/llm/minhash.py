"""Document fingerprints: MinHash signatures of word shingles, computed by numpy for many texts at once.

A text's shingles are its runs of WIDTH words (A-Z lower-cased); a text with fewer words has them all
as one; a text without words has none. Each of PERMUTATIONS universal hashes x -> a*x + b modulo
2**32, a odd, permutes the shingles' 32-bit hashes, and the least value of each is kept, of which
the fingerprint shows 8 bits in hexadecimal. Likeness of fingerprints is the share of equal bytes,
less the 1/256 of chance. bands.py joins bands of signatures in Spark and verifies Jaccard.

Null is empty; empty texts are alike (1.0). In descending order of doc_id null comes last, and ties
are ordered by text. Repeated rows are rows like others. The only row is its own next. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices
from .textkernel import Words, expand, raw_bytes, window_hashes, within, words

PERMUTATIONS, WIDTH = 128, 5
BANDS = 32
_rng = np.random.Generator(np.random.PCG64(42))
_A = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
#: Shingles that are hashed at once, so that they stay in a CPU's cache.
_BLOCK = 1 << 15


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles in a row, and each text's first."""
    h = w.hashes()
    counts = np.diff(w.first)
    whole = within(w.first, width)
    found = window_hashes(h, width)[whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(first[-1]), np.uint64)
    long = counts >= width
    out[expand(first[:-1][long], sizes[long])] = found
    for size in range(1, width):
        of = short[counts[short] == size]
        if len(of):
            runs = window_hashes(h[expand(w.first[:-1][of], np.full(len(of), size))], size, seed=7 + size)[::size]
            out[first[:-1][of]] = runs
    return out, first


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least values of all permutations per text; a text without shingles has the greatest value."""
    n = len(first) - 1
    out = np.full((n, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    at = 0
    while at < len(full):
        upto = max(at + 1, int(np.searchsorted(first[full], first[full[at]] + _BLOCK)))
        of = full[at:upto]
        lo, hi = int(first[of[0]]), int(first[of[-1] + 1])
        part, begins = x[lo:hi], first[of] - lo
        values = np.empty_like(part)
        for p in range(PERMUTATIONS):
            np.multiply(part, _A[p], out=values)
            values += _B[p]
            out[of, p] = np.minimum.reduceat(values, begins)
        at = upto
    return out


def sign(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    return signatures(*shingles(words(texts, lower=True), width))


def classes_of(texts: pa.Array) -> list[pa.Array]:
    """Size and class of each text's set."""
    from . import jaccard  # which takes its shingles from here

    h, first = jaccard.sets(texts, WIDTH)
    return [pa.array(np.diff(first), pa.int64()), jaccard._struct(*jaccard.class_ids(h, first))]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard of signatures of equal rank, from 8 bits of each value."""
    same = ((a ^ b) & np.uint32(0xFF) == 0).mean(axis=1)
    return np.clip((same - 1 / 256) / (1 - 1 / 256), 0, 1)


def shown(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signature.astype(np.uint8)]


def edited(data: np.ndarray, offsets: np.ndarray, next_data: np.ndarray, next_offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Each text with its last floor(n/2) code points replaced by the next text's first as many, and n."""
    head, head_next = np.flatnonzero((data & 0xC0) != 0x80), np.flatnonzero((next_data & 0xC0) != 0x80)
    char, char_next = np.searchsorted(head, offsets), np.searchsorted(head_next, next_offsets)
    n, m = np.diff(char), np.diff(char_next)
    place = np.append(head, len(data))[char[:-1] + n - n // 2]
    place_next = np.append(head_next, len(next_data))[char_next[:-1] + np.minimum(n // 2, m)]
    kept, added = place - offsets[:-1], place_next - next_offsets[:-1]
    both = np.concatenate([data, next_data])
    starts = np.stack([offsets[:-1], next_offsets[:-1] + len(data)], axis=1).reshape(-1)
    sizes = np.stack([kept, added], axis=1).reshape(-1)
    out = both[expand(starts, sizes)]
    edge = np.concatenate([[0], np.cumsum(kept + added)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(edge.tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.large_string()), n


def _part(bounds: list[int], doc_id: Column, low: int = 0) -> Column:
    """Number of the bounds (descending) that are at least doc_id, less one: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low - 1)
    mid = len(bounds) // 2
    return F.when(doc_id <= F.lit(bounds[mid]), _part(bounds[mid + 1 :], doc_id, low + mid + 1)).otherwise(_part(bounds[:mid], doc_id, low))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", classed: bool = False) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; n_shingles and cid of its set if classed.

    Rows are dealt by ranges of doc_id whose bounds are ids of the table; the document at each bound
    also goes to the range before it, as the next of that range's last.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / parts for i in range(1, parts)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", probs, 100 * parts).alias("b"), F.max("doc_id").alias("top")).first()
    bounds = sorted({*(found["b"] or []), found["top"]} - {None}, reverse=True)
    n = max(1, len(bounds))
    key = F.coalesce(_part(bounds, F.col("doc_id")), F.lit(n - 1))
    own = docs.withColumns({"part": F.when(F.col("doc_id").isNull(), n - 1).otherwise(F.greatest(key, F.lit(0))).cast("int"), "guest": F.lit(0)})
    guests = docs.where(F.col("doc_id").isin(bounds)).withColumns({"part": F.pmod(_part(bounds, F.col("doc_id")) - 1, F.lit(n)).cast("int"), "guest": F.lit(1)}) if bounds else own.limit(0)
    dealt = own.unionByName(guests).repartitionById(max(n, parts), "part").sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if classed:
        schema += ", n_shingles long, cid struct<x:long,y:long>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = opening = None
        for batch in slices(batches, "text"):
            opening = batch.slice(0, 1) if opening is None else opening
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            whole = table.to_batches()[0]
            yield digest(whole)
            held = whole.slice(whole.num_rows - 1)
        if held is not None and not held.column("guest")[0].as_py():  # no guest: the order ends here and goes on at its start
            yield digest(pa.Table.from_batches([held, opening]).combine_chunks().to_batches()[0])

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Of all rows but the last, which is only the next of the one before."""
        n, col = batch.num_rows - 1, batch.column("text")
        data, offsets = raw_bytes(col)
        own = sign(col)
        texts, chars = edited(data, offsets[:-1], data[offsets[1] :] if n else data, offsets[1:] - offsets[1])
        other = sign(texts)
        hosts = pa.compute.equal(batch.column("guest"), 0).slice(0, n)
        more = classes_of(col.slice(0, n)) if classed else []
        out = pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").slice(0, n),
                pa.array(chars, pa.int64()),
                pa.array([hashlib.sha256(x or b"").hexdigest() for x in texts.cast(pa.large_binary()).to_pylist()], pa.string()),
                pa.array(shown(own[:-1]), pa.string()),
                pa.array(shown(other), pa.string()),
                pa.array(likeness(own[:-1], other)),
                pa.array(likeness(own[:-1], own[1:])),
                *more,
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", *(["n_shingles", "cid"] if classed else [])],
        )
        return out.filter(hosts)

    return dealt.mapInArrow(rows, schema)
