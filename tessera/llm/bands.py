"""Near-duplicates by MinHash bands: lists of classes that share a band, links verified on whole sets.

A signature of 128 values has 32 bands of eight, each of which shares four values with the next; sets
of Jaccard 0.8 share one with a chance of about 0.99, and sets of 0.4, as texts with a passage in common
may be, with one of about 0.02. Classes of equal sets are one row. Within a list, classes are compared
with its hub first and then only across components, as in jaccard.py, so a large group of copies isn't
paired within itself. The hub is the class with the fewest shingles of its own, that is in no other class that
shares a band: in a group of near copies the one nearest to all. Own shingles also bound what two
sets can have in common, which leaves out most pairs of a group whose texts are less alike than a link needs,
and of the rest the joins give only those whose parity signatures allow a link. No link is lost by either.

Null and empty texts have no bands and link with nothing; repeated rows are documents of one class;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitfilter, jaccard, minhash
from .common import checkpointed, dropped, freed, prepare, shared_dir, slices
from .textkernel import U, mix


def bands(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each band per set."""
    s = minhash.signatures(hashes, first).astype(U).reshape(len(first) - 1, minhash.BANDS, -1)
    out = np.broadcast_to(np.arange(minhash.BANDS, dtype=U), s.shape[:2]).copy()
    for k in range(s.shape[2]):
        out = mix(out * U(0x9E3779B97F4A7C15) + s[:, :, k])
    return mix(out * U(0x9E3779B97F4A7C15) + np.roll(out, -1, axis=1))


def described(docs: DataFrame, width: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = jaccard.sets(batch.column("text"), width)
            size, k = np.diff(first), minhash.BANDS
            kept = np.where(size > 0, k, 0)
            edge = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), jaccard._struct(*jaccard.class_ids(h, first)), pa.ListArray.from_arrays(pa.array(edge), pa.array(bands(h, first)[size > 0].reshape(-1).view(np.int64))), jaccard.parities(h, first)],
                names=["doc_id", "size", "cid", "bands", "parity"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"doc_id {kind}, size long, cid {jaccard._CLASS}, bands array<long>, parity array<long>")


def compared(docs: DataFrame, banded: DataFrame, shared: Broadcast, folder: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Of the classes that may share a band: (cid, text), a text of each; and (cid, own), shingles that none of the others has, at least.

    shared: the filter of bands of more than one class. A filter of shingles in its turn tells own ones; what it lets
    pass wrongly counts as shared.
    """
    spark = docs.sparkSession

    def sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bands")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            of = np.unique(row[bitfilter.passing(shared.value, lists.flatten().to_numpy(zero_copy_only=False).view(U))])
            yield pa.RecordBatch.from_arrays([batch.column("x").take(pa.array(of))], names=["x"])

    asked = checkpointed(banded.select("cid.x", "bands").mapInArrow(sharing, "x long"), folder, "asked")
    asked_for = spark.sparkContext.broadcast(bitfilter.build(asked, "x"))
    dropped(spark, folder, "asked")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = jaccard.sets(batch.column("text"), width)
            x, y = jaccard.class_ids(h, first)
            of = np.flatnonzero(bitfilter.passing(asked_for.value, x) & (np.diff(first) > 0))
            of = of[np.sort(np.unique(x[of], return_index=True)[1])]
            yield pa.RecordBatch.from_arrays([jaccard._struct(x[of], y[of]), batch.column("text").take(pa.array(of))], names=["cid", "t"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(jaccard.sets(batch.column("text"), width)[0].view(np.int64))], names=["h"])

    found = docs.select("text").mapInArrow(texts, f"cid {jaccard._CLASS}, t string").groupBy("cid").agg(F.first("t").alias("text"))
    found = checkpointed(found, folder, "compared")
    twice = found.select("text").mapInArrow(each, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    common = spark.sparkContext.broadcast(bitfilter.build(checkpointed(twice, folder, "twice")))
    dropped(spark, folder, "twice")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = jaccard.sets(batch.column("text"), width)
            alone = np.concatenate([[0], np.cumsum(~bitfilter.passing(common.value, h))])
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(alone[first[1:]] - alone[first[:-1]], pa.int64())], names=["cid", "own"])

    return found, checkpointed(found.mapInArrow(counted, f"cid {jaccard._CLASS}, own long"), folder, "own")


def classes(docs: DataFrame, folder: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(cid, best) of every class of docs (doc_id, text): the least doc_id of its component."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text")
    wide = checkpointed(described(docs, width), folder, "banded")
    banded = checkpointed(wide.where("size > 0").groupBy("cid").agg(*[F.first(c).alias(c) for c in ("size", "bands", "parity")]), folder, "classes")
    told = checkpointed(wide.drop("bands", "parity"), folder, "documents")
    dropped(spark, folder, "banded")
    shared = spark.sparkContext.broadcast(jaccard.often(banded, folder, "bands"))
    texts, own = compared(docs, banded, shared, folder, width)
    # A set can't link if more of it stands in no other set than a link may leave out.
    able = banded.join(own, "cid").where(F.col("own") * den <= F.col("size") * (den - num))
    index = jaccard.listed(able, folder, "bands", num, den, shared, ("own", "parity")).drop("pos").withColumnRenamed("own", "pos")
    linked = jaccard.connected(texts.select("text"), index, banded.select("cid", "size", "parity"), folder, width, num, den)
    dropped(spark, folder, "classes", "compared", "own")
    best = jaccard.by_component(told, linked, folder, F.col("doc_id"))
    dropped(spark, folder, "documents")
    return best


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, folder: str | None = None) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (least doc_id of its component; its own if its set is empty)."""
    folder = folder or shared_dir(docs.sparkSession)
    best = classes(docs, folder, width, num, den)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = jaccard.sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), jaccard._struct(*jaccard.class_ids(h, first))], names=["doc_id", "n_shingles", "cid"])

    told = docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_shingles long, cid {jaccard._CLASS}")
    return with_class(told, best)


def with_class(told: DataFrame, best: DataFrame) -> DataFrame:
    """told (doc_id, n_shingles, cid, ...) with class_id in place of cid."""
    joined = told.join(best, "cid", "left")
    return joined.withColumn("class_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("best"))).drop("cid", "best")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """minhash.fingerprints with n_shingles and class_id: bands of signatures joined, links verified at 0.8 of five words."""
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    best = classes(named, shared_dir(spark), minhash.WIDTH)
    freed(spark)
    return with_class(minhash.fingerprints(named, classed=True), best)
