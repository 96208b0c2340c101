"""Substring deduplication over a log-structured index of window fingerprints.

A window is WINDOW consecutive words of one document. Its fingerprint is the hash of its least run
of RUN words (its anchor); consecutive windows with one anchor are one entry of the index: the
anchor's hash and a hash of all their words. Equal windows have equal anchors at equal places, so a
window can be repeated only where its anchor's hash is.

The index is a set of immutable runs in a folder: tables of one row an anchor, with its number of
entries and the least and greatest hash of their words, bucketed and sorted by anchor. A new batch
becomes a run itself and is merge-joined with the historical runs, bucket by bucket and without a
shuffle; anchors that it repeats, in itself or in history, are its hits. When there are too many runs,
they are compacted into one. A manifest names the runs, so an index can be opened again from its folder.

The documents are then read again for the entries of all hits, older documents' too. An entry seen
twice is repeated whole; windows whose anchor is seen with different words around it are verified one
by one on hashes of all their words. Anchor and words are hashed by independent 64-bit codes, 128 bits
together. Rows of an anchor are combined in each task before any shuffle.

Null and empty texts and texts with fewer words than a window lose nothing. Repeated rows repeat
each other's windows. Removal depends on the text alone, so ties and null ids change nothing, and ids
may be of any type. An empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitfilter
from .common import checkpointed, dropped, prepare, shared_dir, slices
from .textkernel import U, Words, expand, mix, powers, sliding_argmin, window_hashes, within, words

WINDOW, RUN = 35, 8
MOST_RUNS = 4
BATCHES = 2
#: Entries that a task holds before it combines them, and anchors that it holds combined.
HELD = 200_000


class Anchors:
    """Index entries of a slice of texts: each entry's row, first and last window start, anchor and words."""

    def __init__(self, w: Words, window: int) -> None:
        run = min(RUN, window)
        grams = window_hashes(w.hashes(1), run, seed=9)
        least = sliding_argmin(grams, window - run + 1)
        starts = np.flatnonzero(within(w.first, window))
        at = least[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(fresh)
        self.low = starts[begin]
        self.high = starts[np.append(begin[1:], len(starts)) - 1] if len(starts) else self.low
        place = at[begin]
        self.anchor = grams[place] if len(begin) else np.zeros(0, U)
        other = w.hashes(2)
        p, self.inverse = powers(len(other) + 1)
        self.sums = np.zeros(len(other) + 1, U)
        np.cumsum(other * p[: len(other)], out=self.sums[1:])
        shape = ((place - self.low) * 4096 + (self.high - self.low)).astype(U)
        self.context = mix((self.sums[self.high + window] - self.sums[self.low]) * self.inverse[self.low] + mix(shape + U(1)))
        self.row = np.searchsorted(w.first, self.low, side="right") - 1
        self.window = window

    def windows(self, of: np.ndarray) -> np.ndarray:
        """Hashes of all windows of the entries, in a row."""
        s = expand(self.low[of], self.high[of] - self.low[of] + 1)
        return mix((self.sums[s + self.window] - self.sums[s]) * self.inverse[s])


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def entries(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, n, lo, hi) of docs' anchors: number of entries, least and greatest hash of their words, as combined by each task."""

    def combined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        h, n, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h = h[order]
        begin = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        return (h[begin], *(f.reduceat(x[order], begin) if len(h) else x for f, x in ((np.add, n), (np.minimum, lo), (np.maximum, hi))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for batch in slices(batches, "text"):
            a = Anchors(words(batch.column("text")), window)
            h, c = a.anchor.view(np.int64), a.context.view(np.int64)
            held.append((h, np.ones(len(h), np.int64), c, c))
            waiting += len(h)
            if waiting > HELD:
                held, waiting = [combined(held)], 0
                if len(held[0][0]) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["h", "n", "lo", "hi"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in combined(held)], names=["h", "n", "lo", "hi"])

    return docs.select("text").mapInArrow(rows, "h long, n long, lo long, hi long")


class FingerprintIndex:
    """Runs of (h, n, lo, hi) in a folder, and the manifest that names them; opened again where there is one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.runs, self.made = spark, folder, [], 0
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"runs_{uuid.uuid4().hex}"
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = self._fs.globStatus(self._path(f"{folder}/manifest-*.json")) or []
        if len(found):
            latest = max(str(x.getPath().toString()) for x in found)
            kept = json.loads(spark.read.text(latest, wholetext=True).first()[0])
            self.runs, self.made, self.buckets = kept["runs"], kept["made"], kept["buckets"]
            for run in self.runs:
                spark.sql(f"CREATE TABLE {self._table(run)} (h long, n long, lo long, hi long) USING parquet CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{folder}/{run}'")

    def _table(self, run: str) -> str:
        return f"{self.name}_{run}"

    def read(self, run: str) -> DataFrame:
        return self.spark.table(self._table(run))

    def _run(self, rows: DataFrame) -> str:
        """A new run of rows that may repeat an anchor."""
        self.made += 1
        run = f"run_{self.made:06d}"
        one = rows.repartition(self.buckets, "h").groupBy("h").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        one.sortWithinPartitions("h").write.bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.folder}/{run}").mode("overwrite").saveAsTable(self._table(run))
        return run

    def _publish(self, runs: list[str]) -> None:
        """The manifest is complete under another name before it gets its own; it goes up by one with each run made."""
        made = self._path(f"{self.folder}/.manifest-{self.made:06d}")
        out = self._fs.create(made, True)
        out.write(json.dumps({"runs": runs, "made": self.made, "buckets": self.buckets}).encode())
        out.close()
        if not self._fs.rename(made, self._path(f"{self.folder}/manifest-{self.made:06d}.json")):
            raise RuntimeError(f"another writer has published run {self.made} in {self.folder}")
        gone, self.runs = set(self.runs) - set(runs), runs
        for run in gone:
            self._drop(run)

    def _drop(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run)}")
        self._fs.delete(self._path(f"{self.folder}/{run}"), True)

    def hits(self, run: str, history: list[str]) -> DataFrame:
        """(h, mixed) of the run's anchors that are repeated, in it or by history; mixed: with different words around them."""
        found = self.read(run)
        lo, hi, again = [F.col("lo")], [F.col("hi")], F.col("n") > 1
        for i, old in enumerate(history):
            found = found.join(self.read(old).select("h", F.col("lo").alias(f"lo_{i}"), F.col("hi").alias(f"hi_{i}")).hint("merge"), "h", "left")
            lo, hi, again = [*lo, F.col(f"lo_{i}")], [*hi, F.col(f"hi_{i}")], again | F.col(f"lo_{i}").isNotNull()
        least, most = (F.least(*lo), F.greatest(*hi)) if history else (lo[0], hi[0])
        return found.where(again).select("h", (least != most).alias("mixed"))

    def add(self, batch: DataFrame) -> DataFrame:
        """Add a batch of entries as a run, compact when there are more than MOST_RUNS; the batch's hits."""
        run, history = self._run(batch), list(self.runs)
        found = checkpointed(self.hits(run, history), self.folder, f"hits_{uuid.uuid4().hex}")
        self._publish([*history, run])
        if len(self.runs) > MOST_RUNS:
            self.compact()
        return found

    def compact(self) -> None:
        """Merge all runs into one; the old ones go once the new one is complete."""
        if len(self.runs) > 1:
            every = self.spark.read.schema("h long, n long, lo long, hi long").parquet(*[f"{self.folder}/{run}" for run in self.runs])
            self._publish([self._run(every)])

    def delete(self) -> None:
        for run in self.runs:
            self._drop(run)
        self._fs.delete(self._path(self.folder), True)


def occurrences(docs: DataFrame, repeated: np.ndarray, mixed: np.ndarray, window: int) -> DataFrame:
    """Entries whose anchor may be repeated: d, t, low, high, h, c, and their windows' hashes where the anchor's surroundings differ."""
    shared = docs.sparkSession.sparkContext.broadcast((repeated, mixed))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = words(batch.column("text"))
            a = Anchors(w, window)
            of = np.flatnonzero(bitfilter.passing(shared.value[0], a.anchor))
            more = bitfilter.passing(shared.value[1], a.anchor[of])
            sizes = np.where(more, a.high[of] - a.low[of] + 1, 0)
            edge = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            row, base = a.row[of], w.first[a.row[of]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(row)) for k in ("d", "t")), pa.array((a.low[of] - base).astype(np.int32)), pa.array((a.high[of] - base).astype(np.int32)), _long(a.anchor[of]), _long(a.context[of]), pa.ListArray.from_arrays(pa.array(edge), _long(a.windows(of[more])))],
                names=["d", "t", "low", "high", "h", "c", "w"],
            )

    return docs.mapInArrow(rows, "d long, t long, low int, high int, h long, c long, w array<long>")


def repeated_spans(docs: DataFrame, folder: str, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """For each row key (d, t) of docs, the spans of words covered by repeated windows: spans array of (low, high)."""
    spark = docs.sparkSession
    index, hits = FingerprintIndex(spark, f"{folder}/index"), None
    for b in range(batches):
        found = index.add(entries(docs.where(F.pmod("t", F.lit(batches)) == b), window))
        hits = found if hits is None else hits.unionByName(found)
    anchors = checkpointed(hits.groupBy("h").agg(F.max("mixed").alias("mixed")), folder, "anchors")  # the last batch to hit has seen all of history
    index.delete()
    found = checkpointed(occurrences(docs, bitfilter.build(anchors), bitfilter.build(anchors.where("mixed")), window), folder, "occurrences")
    dropped(spark, folder, "anchors")
    # Tables, so that the joins can split an entry or window that many documents share.
    twice = checkpointed(found.groupBy("h", "c").agg(F.count("*").alias("n")).where("n > 1").select("h", "c", F.lit(True).alias("whole")), folder, "twice")
    judged = found.join(twice, ["h", "c"], "left")
    whole = judged.where("whole").select("d", "t", "low", (F.col("high") + window - 1).alias("high"))
    again = checkpointed(found.select("h", F.explode("w").alias("w")).groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1").select("h", "w"), folder, "again")
    single = judged.where("whole is null and size(w) > 0").select("d", "t", "low", "h", F.posexplode("w").alias("k", "w")).join(again, ["h", "w"])
    single = single.select("d", "t", (F.col("low") + F.col("k")).alias("low"), (F.col("low") + F.col("k") + window - 1).alias("high"))
    return whole.unionByName(single).groupBy("d", "t").agg(F.collect_set(F.struct("low", "high")).alias("spans"))  # a set: at most a text's own windows


def keyed(doc_id: str, text: str) -> dict[str, Column]:
    """Key of a row's content; ids that share a hash do no harm, as removal depends on the text."""
    return {"d": F.xxhash64(F.col(doc_id)), "t": F.xxhash64(F.coalesce(F.col(text), F.lit("")))}


def removed(batch: pa.RecordBatch, text: str, spans: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Per row: words, removed words, kept words joined by one space."""
    w = words(batch.column(text))
    n = len(w.start)
    lists = batch.column(spans)
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    base = np.repeat(w.first[:-1], sizes)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, flat.field("low").to_numpy(zero_copy_only=False) + base, 1)
    np.add.at(delta, flat.field("high").to_numpy(zero_copy_only=False) + base + 1, -1)
    keep = np.cumsum(delta[:n]) == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[w.first]
    start, size = w.start[keep], (w.end - w.start)[keep] + 1
    data = np.append(w.data, np.uint8(0x20))[expand(start, size)]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data[ends[1:] - 1] = 0x20
    joined = [data[ends[a] : max(ends[a], ends[b] - 1)].tobytes() for a, b in zip(kept.tolist(), kept[1:].tolist(), strict=False)]
    return np.diff(w.first), np.diff(w.first) - np.diff(kept), joined


def _spanned(docs: DataFrame, folder: str, doc_id: str, text: str, window: int, batches: int) -> DataFrame:
    prepare(docs.sparkSession)
    keys = keyed(doc_id, text)
    spans = repeated_spans(docs.select(F.col(text).alias("text"), *(v.alias(k) for k, v in keys.items())), folder, window, batches)
    spans = spans.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("spans").alias("__spans"))
    return docs.join(spans, (keys["d"] == F.col("__d")) & (keys["t"] == F.col("__t")), "left").drop("__d", "__t")


def digests(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES, folder: str | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    docs = docs.select("doc_id", "text")
    joined = _spanned(docs, folder or shared_dir(docs.sparkSession), "doc_id", "text", window, batches)

    def rows(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(given, "text"):
            n, gone, kept = removed(batch, "text", "__spans")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept])], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(rows, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def strip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, batches: int = BATCHES, folder: str | None = None) -> DataFrame:
    """docs with their texts less the repeated windows; texts that lose nothing are left as they are."""
    schema = docs.schema
    joined = _spanned(docs, folder or shared_dir(docs.sparkSession), doc_id, text, window, batches)

    def rows(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(given, text):
            _, gone, kept = removed(batch, text, "__spans")
            old = batch.column(text).to_pylist()
            new = pa.array([k.decode() if g else o for g, k, o in zip(gone.tolist(), kept, old, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([new if name == text else batch.column(name) for name in schema.names], names=schema.names)

    return joined.mapInArrow(rows, schema)
