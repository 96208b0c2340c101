"""Token-id output: documents' ids in Simple-8b files, in ascending doc_id order, and their reader.

A shard file holds blocks of 1,024 ids across documents, then a footer: each block's word offset,
the doc_id and the number of ids of each document. Shards follow each other in doc_id order, so a
document's place among all ids is its shard's offset plus its place in the shard. A shard is closed when
it is full, so that a task holds the footer of one of bounded size. Text that spells an added token is
that token, as the library has it.

Nulls and empty texts give a document of the end id alone. A null doc_id sorts before all others.
Repeated doc_ids are kept, each row by itself, in the order of their texts. An empty table gives no
rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chunks, files, simple8b
from .common import checkpointed, prepare, resident, shared_dir, slices

MAGIC = b"TS8B\x01\x00\x00\x00"
CACHE_ENTRIES = 1_500_000
#: Ids that are packed or unpacked at once.
AT_ONCE = 512 * simple8b.BLOCK
#: Ids and documents after which a shard file is closed and another one begun.
SHARD_IDS, SHARD_DOCS = 1 << 26, 1 << 20


class LibraryEncoder:
    """Chunks to ids by the tokenizers library; one for each worker and vocabulary."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        vocab = self.model.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)  # one character stands for each byte
        self.cache = chunks.Cache(CACHE_ENTRIES)

    def close(self) -> None:
        self.cache = None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spaced, bare = chunks.joinable(data, start, end)
        sizes = np.zeros(len(start), np.int32)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for of, fed in ((np.flatnonzero(spaced), 0), (np.flatnonzero(bare), 1)):
            if not len(of):
                continue
            long = end[of] - start[of] + fed
            joined = np.full(int(long.sum()), 0x0A, np.uint8)
            ends = np.cumsum(long)
            joined[chunks.expand(ends - long + fed, long - fed)] = data[chunks.expand(start[of], long - fed)]
            joined = joined.tobytes()
            cuts = [0, *(np.flatnonzero(np.diff(ends >> 15)) + 1).tolist(), len(of)]
            texts = [joined[(ends[a - 1] if a else 0) : ends[b - 1]].decode() for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
            ids = np.concatenate([np.array(x, np.int32) for x in self._ids(texts)])
            after = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1
            counts = np.diff(after, prepend=0)
            if fed:
                ids = np.delete(ids, after - counts)
            sizes[of] = counts - fed
            parts.append((of, ids))
        rest = np.flatnonzero(~(spaced | bare))
        if len(rest):
            found = self._ids([data[a:b].tobytes().decode() for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)])
            sizes[rest] = [len(x) for x in found]
            parts.append((rest, np.array([i for x in found for i in x], np.int32)))
        return sizes, chunks.gathered(parts, sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and each text's first. Texts that hold an added token's content aren't cut."""
        whole = np.zeros(len(texts), bool)
        for content in self.special:
            whole |= pa.compute.fill_null(pa.compute.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return chunks.encode(texts, self.cache, self)
        ids, first = chunks.encode(pa.compute.if_else(pa.array(whole), None, texts), self.cache, self)
        sizes = np.diff(first)
        found = self._ids(texts.filter(pa.array(whole)).to_pylist())
        of = np.flatnonzero(whole)
        sizes[of] = [len(x) for x in found]
        every = chunks.gathered([(np.flatnonzero(~whole), ids), (of, np.array([i for x in found for i in x], np.int32))], sizes)
        return every, np.concatenate([[0], np.cumsum(sizes)])


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row and each text's first, by the vocabulary file at path."""
    return resident((__name__, path), lambda: LibraryEncoder(path)).encode(texts)


class ShardWriter:
    """Packs a stream of documents' ids into one file."""

    def __init__(self, uri: str) -> None:
        self.out = files.create(uri)
        self.out.write(MAGIC)
        self.rest: list[np.ndarray] = []
        self.waiting = self.total = self.n_docs = 0
        self.sizes: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, docs: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs.astype("<i8"))
        self.known.append(known.astype(np.uint8))
        self.counts.append(counts.astype("<u8"))
        self.rest.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        self.n_docs += len(docs)
        if self.waiting >= AT_ONCE:
            self._pack(self.waiting // AT_ONCE * AT_ONCE)

    def _pack(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.int32)
        for i in range(0, n, AT_ONCE):
            words, sizes = simple8b.encode(ids[i : min(n, i + AT_ONCE)])
            self.out.write(words.astype("<u8").tobytes())
            self.sizes.append(sizes)
        self.rest, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        """Number of documents and of ids."""
        self._pack(self.waiting)
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        sizes, docs = join(self.sizes, "<u4"), join(self.docs, "<i8")
        for part in (sizes, docs, join(self.known, "u1"), join(self.counts, "<u8")):
            self.out.write(part.tobytes())
        self.out.write(struct.pack("<QQQ", len(sizes), len(docs), self.total) + MAGIC)
        self.out.close()
        return len(docs), self.total


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards of docs below folder; the manifest, one row a shard: part, number in it, path, n_docs, n_ids."""
    spark = docs.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, uri = TaskContext.get().partitionId(), None, ""

        def closed_row() -> pa.RecordBatch:
            n_docs, n_ids = writer.close()
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "path": [uri], "n_docs": [n_docs], "n_ids": [n_ids]})

        number = 0
        for batch in slices(batches, "text", keep=True):
            if writer is not None and (writer.total >= SHARD_IDS or writer.n_docs >= SHARD_DOCS):
                yield closed_row()
                writer, number = None, number + 1
            if writer is None:
                uri = files.new_name(f"{folder}/shards", f"{part:06d}-{number:06d}")
                writer = ShardWriter(uri)
            ids, first = encode_texts(batch.column("text"), vocabulary)
            closed = np.zeros(len(ids) + batch.num_rows, np.uint32)
            closed[np.arange(len(ids)) + np.repeat(np.arange(batch.num_rows), np.diff(first))] = ids
            closed[first[1:] + np.arange(batch.num_rows)] = end_id
            key = batch.column("doc_id")
            writer.add(key.fill_null(0).to_numpy(zero_copy_only=False), key.is_valid().to_numpy(zero_copy_only=False), np.diff(first) + 1, closed)
        if writer is not None:
            yield closed_row()

    return checkpointed(ordered.mapInArrow(shard, "part long, number long, path string, n_docs long, n_ids long"), folder, "manifest")


class ShardReader:
    """Documents of a shard, whole blocks at a time."""

    def __init__(self, uri: str) -> None:
        self.file = files.open_input(uri)
        size = self.file.size()
        tail = self.file.read_at(32, size - 32)
        blocks, docs, self.total = struct.unpack("<QQQ", tail[:24])
        if tail[24:] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        foot = self.file.read_at(blocks * 4 + docs * 17, size - 32 - blocks * 4 - docs * 17)
        self.sizes = np.frombuffer(foot, "<u4", blocks).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])  # of blocks, in words
        self.docs = np.frombuffer(foot, "<i8", docs, blocks * 4)
        self.known = np.frombuffer(foot, "u1", docs, blocks * 4 + docs * 8).astype(bool)
        self.counts = np.frombuffer(foot, "<u8", docs, blocks * 4 + docs * 9).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin .. end of the shard; reads and decodes only the blocks that hold them."""
        a, b = begin // simple8b.BLOCK, -(-end // simple8b.BLOCK)
        lo, hi = int(self.offsets[a]), int(self.offsets[b])
        words = np.frombuffer(self.file.read_at((hi - lo) * 8, len(MAGIC) + lo * 8), "<u8")
        total = min(self.total, b * simple8b.BLOCK) - a * simple8b.BLOCK
        return simple8b.decode(words, self.sizes[a:b], total)[begin - a * simple8b.BLOCK : end - a * simple8b.BLOCK]


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document of the shards in the manifest: doc_id, start, n_tokens, ids_crc32."""
    prepare(manifest.sparkSession)
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    placed = manifest.select("part", "number", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionById(parts, F.col("part").cast("int"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                shard = ShardReader(path)
                edge = np.concatenate([[0], np.cumsum(shard.counts)])
                done = 0
                while done < len(shard.docs):
                    upto = max(done + 1, int(np.searchsorted(edge, edge[done] + AT_ONCE, "right")) - 1)
                    ids = shard.ids(int(edge[done]), int(edge[upto])).astype("<u4")
                    crc = [zlib.crc32(ids[edge[d] - edge[done] : edge[d + 1] - edge[done]].tobytes()) for d in range(done, upto)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.docs[done:upto], mask=~shard.known[done:upto]), pa.array(edge[done:upto] + offset, pa.int64()), pa.array(shard.counts[done:upto], pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    done = upto

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    folder = shared_dir(spark)
    return read_digests(write(docs, folder, vocabulary, end_id))
