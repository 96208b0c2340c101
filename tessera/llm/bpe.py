"""Byte-level BPE by DuckDB recursive queries in each partition, and its inverse.

Every distinct match of the pattern that a task meets becomes token-position rows, one for each
byte. A recursive query joins neighbouring rows with the merge table and contracts each word's
leftmost pair of least rank, until no word has a pair left. The recursion keeps the rows of all its
steps, so one query's words are bounded by those rows, and matches of more than LONG bytes are
contracted in the same order from a heap, in memory linear in their length. Decoding joins ids with
the vocabulary and concatenates the bytes in an ordered aggregation, a bounded piece of the ids at a
time; the tokens' lengths cut its result. Only numpy gathers stand between distinct words and documents.

Nulls and empty texts have no tokens. Rows are independent, so ties, repeated rows and null ids of
documents change nothing; an empty table gives no rows. Texts need not hold any spaces, and a match
may be of any length: n bytes take up to n contractions.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import prepare, resident, slices
from .textkernel import expand

#: Text bytes encoded at once; with the cache and DuckDB's limit this keeps a worker near 400 MB.
SLICE = 3 << 18
CACHE_ENTRIES = 800_000
#: Bytes of distinct words in one recursive query, rows of all its steps at most, and bytes of its longest word.
QUERY_BYTES, QUERY_ROWS, LONG = 60_000, 500_000, 128
#: Bytes decoded by one query; an id counts as four at least.
DECODE_BYTES = 800_000

# A merge's key is its rank, a pair's is followed by the places of both tokens, which are below 256.
ENCODE = """
WITH RECURSIVE state(w, p, t, np, nt, step) AS (
    SELECT w, p, t, lead(p) OVER (PARTITION BY w ORDER BY p), lead(t) OVER (PARTITION BY w ORDER BY p), 0 FROM symbols
  UNION ALL
    SELECT k.w, k.p, CASE WHEN k.p = b.p THEN b.merged ELSE k.t END,
           CASE WHEN k.p = b.p THEN b.after ELSE k.np END,
           CASE WHEN k.p = b.p THEN b.after_t WHEN k.np = b.p THEN b.merged ELSE k.nt END, k.step + 1
    FROM state k JOIN (
        SELECT l.w, ((l.best >> 8) & 255)::INT AS p, (l.best & 255)::INT AS gone, (l.best >> 16)::INT AS merged, g.np AS after, g.nt AS after_t
        FROM (SELECT n.w, min(m.key | (n.p << 8) | n.np) AS best FROM state n JOIN merges m ON n.t = m.a AND n.nt = m.b GROUP BY n.w) l
          JOIN state g ON g.w = l.w AND g.p = (l.best & 255)) b ON k.w = b.w
    WHERE k.p <> b.gone
)
SELECT s.w, s.t FROM state s JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) f ON s.w = f.w AND s.step = f.step ORDER BY s.w, s.p
"""
# Bytes stand as characters U+0000 to U+00FF.
DECODE = "SELECT string_agg(v.bytes, '' ORDER BY i.p) FROM ids i JOIN vocabulary v ON i.t = v.id"


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def connect() -> object:
    import duckdb

    db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "100MB", "temp_directory": ""})
    db.execute("SET preserve_insertion_order = true")
    return db


class DuckBpe:
    """Vocabulary and merge table in a worker's DuckDB, and the words it has encoded."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.ranks = ranks(path)
        self.find = regex.compile(pattern).findall
        self.db = connect()
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.width = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.width[list(self.ranks.values())] = [len(t) for t in self.ranks]
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        a, b, r = (pa.array(x, pa.int32()) for x in zip(*pairs, strict=True))
        self._fill("merges", pa.table({"a": a, "b": b, "key": pa.array(r.to_numpy().astype(np.int64) << 16)}))
        self._fill("vocabulary", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "bytes": [t.decode("latin-1") for t in self.ranks]}))
        self.chunks, self.sequences = chunks.Cache(CACHE_ENTRIES), chunks.Cache(CACHE_ENTRIES, np.uint8)
        self.opens = np.zeros(len(self.width), bool)
        self.opens[[i for t, i in self.ranks.items() if t[:1] == b" "]] = True

    def close(self) -> None:
        self.db.close()

    def _fill(self, name: str, data: pa.Table) -> None:
        self.db.register("given", data)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of distinct words: those in the vocabulary at once, the rest by contraction."""
        known = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        size = np.array([len(w) for w in words], np.int64)
        sizes, parts = np.ones(len(words), np.int32), [(np.flatnonzero(known >= 0), known[known >= 0].astype(np.int32))]
        for i in np.flatnonzero((known < 0) & (size > LONG)).tolist():
            ids = self.contract(words[i])
            sizes[i] = len(ids)
            parts.append((np.array([i]), ids))
        open_ = np.flatnonzero((known < 0) & (size <= LONG))
        held, steps = np.cumsum(size[open_]) // QUERY_BYTES, np.cumsum(size[open_] * (size[open_] + 1) // 2) // QUERY_ROWS
        for part in np.split(open_, np.flatnonzero(np.diff(held) | np.diff(steps)) + 1):
            if not len(part):
                continue
            data = [words[i] for i in part.tolist()]
            rows = pa.table({"w": np.repeat(np.arange(len(data), dtype=np.int32), size[part]), "p": expand(np.zeros(len(data), np.int64), size[part]).astype(np.int32), "t": self.byte_id[np.frombuffer(b"".join(data), np.uint8)]})
            self.db.register("symbols", rows)
            found = self.db.execute(ENCODE).fetchnumpy()
            self.db.unregister("symbols")
            sizes[part] = np.bincount(np.asarray(found["w"]), minlength=len(data))
            parts.append((part, np.asarray(found["t"], np.int32)))
        return sizes, chunks.gathered(parts, sizes)

    def contract(self, word: bytes) -> np.ndarray:
        """Ids of one word: its leftmost pair of least rank is contracted until none is left, as in ENCODE."""
        n, rank = len(word), self.ranks.get
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))  # starts of a token's neighbours; after is 0 for a start that is gone
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            key = heappop(heap)
            i = key & 0xFFFFFFFF
            gone = after[i]
            if not 0 < gone < n or rank(word[i : after[gone]]) != key >> 32:
                continue  # that pair is no more
            after[i], after[gone] = after[gone], 0
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := rank(word[a : after[after[a]]])) is not None:
                    heappush(heap, r << 32 | a)
        return np.array([rank(word[i : after[i]]) for i in range(n) if after[i]], np.int32)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of chunks: their matches are encoded, each distinct one once."""
        index: dict[str, int] = {}
        which: list[int] = []
        matches = np.zeros(len(start), np.int64)
        raw = data.tobytes()
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
            found = self.find(raw[a:b].decode())
            matches[i] = len(found)
            which += [index.setdefault(m, len(index)) for m in found]
        sizes, flat = self.encode_words([m.encode() for m in index])
        at = np.array(which, np.int64)
        begin = np.cumsum(sizes, dtype=np.int64) - sizes
        after = np.concatenate([[0], np.cumsum(sizes[at], dtype=np.int64)])[np.concatenate([[0], np.cumsum(matches)])]
        return np.diff(after).astype(np.int32), flat[expand(begin[at], sizes[at])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return chunks.encode(texts, self.chunks, self)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The bytes of each row of ids; ids that the vocabulary lacks have none."""
        ids = ids[int(first[0]) : int(first[-1])].astype(np.int32)
        width = np.where((ids >= 0) & (ids < len(self.width)), self.width[np.clip(ids, 0, len(self.width) - 1)], 0)
        held = np.cumsum(np.maximum(4, width)) // DECODE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(ids)]
        done = []
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi > lo:
                self.db.register("ids", pa.table({"p": np.arange(lo, hi), "t": ids[lo:hi]}))
                done.append((self.db.execute(DECODE).fetchall()[0][0] or "").encode("latin-1"))
                self.db.unregister("ids")
        whole = b"".join(done)
        edge = np.concatenate([[0], np.cumsum(width)])[first - first[0]].tolist()
        return [whole[a:b] for a, b in zip(edge, edge[1:], strict=False)]

    def decode_documents(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decoded bytes of all rows in a row, and each row's first byte; equal runs of ids are decoded once.

        Runs begin at ids whose bytes begin with a space; decoding goes id by id, so any cut is right.
        """
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(first), np.int64)
        begin = self.opens[ids]
        begin[first[:-1][np.diff(first) > 0]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(ids))

        def make(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            size = (end - start)[of]
            texts = self.decode(ids[expand(start[of], size)], np.concatenate([[0], np.cumsum(size)]))
            return np.array([len(x) for x in texts], np.int32), np.frombuffer(b"".join(texts), np.uint8)

        sizes, out = self.sequences.through(ids.astype("<u4").view(np.uint8), start * 4, end * 4, make)
        after = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        return out, after[np.searchsorted(start, first)]


def worker(path: str, pattern: str) -> DuckBpe:
    """This process's encoder; kept until another operator takes the process."""
    return resident((__name__, path, pattern), lambda: DuckBpe(path, pattern))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """df with a column of the ids of its text; a clashing column is replaced."""
    prepare(df.sparkSession)
    df = df.drop(out)
    schema = df.select("*", F.lit(None).cast("array<int>").alias(out)).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE, keep=True):
            ids, first = worker(path, pattern).encode(batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))], names=[*batch.schema.names, out])

    return df.mapInArrow(rows, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with a column of the bytes of its ids; null ids have no bytes; a clashing column is replaced."""
    prepare(df.sparkSession)
    df = df.drop(out)
    schema = df.select("*", F.lit(None).cast("binary").alias(out)).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            first = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists])]).astype(np.int64)
            done = worker(path, pattern).decode(np.array([i for x in lists for i in x or ()], np.int64), first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.binary())], names=[*batch.schema.names, out])

    return df.mapInArrow(rows, schema)


def digests(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: the columns in keep, n_tokens, ids_sha256, decoded_sha256, round_trip (decoded bytes are the text's), ids if asked."""
    prepare(docs.sparkSession)
    docs = docs.select(*keep, *([] if text in keep else [text]))
    schema = docs.select(*keep).withColumns({"n_tokens": F.lit(0).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit(""), "round_trip": F.lit(True), **({"ids": F.lit(None).cast("array<int>")} if with_ids else {})}).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE, keep=True):
            bpe = worker(path, pattern)
            ids, first = bpe.encode(batch.column(text))
            back, edge = bpe.decode_documents(ids, first)
            raw, at = chunks.raw_bytes(batch.column(text))
            data = ids.astype("<u4").tobytes()
            hashed = [hashlib.sha256(data[a * 4 : b * 4]).hexdigest() for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
            texts = [back[a:b].tobytes() for a, b in zip(edge.tolist(), edge[1:].tolist(), strict=False)]
            same = [x == raw[a:b].tobytes() for x, a, b in zip(texts, at.tolist(), at[1:].tolist(), strict=False)]
            more = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(np.diff(first), pa.int64()), pa.array(hashed, pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()), pa.array(same, pa.bool_()), *more], names=schema.names)

    return docs.mapInArrow(rows, schema)
