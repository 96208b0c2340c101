"""Exact n-gram Jaccard self-join by set-relation skipping, as components of linked documents.

A document's set is its distinct runs of `width` words (A-Z lower-cased), or all its words as one if
they are fewer. Two documents link when intersection * den >= union * num.

Documents of equal sets are one class; their answers are the class's. A class is indexed under the
rarest shingles of its set (the prefix that any linked set must share), with the shingle's position
in the order of rarity. An index list is cut into blocks by size and component, and a block knows its
least position: a pair of blocks is skipped whole when its positions or sizes rule out a link.

Answers are derived from similar sets: first each class is compared only with its lists' hubs, the
sets of least position. A class that links with a hub takes over the hub's component, and from then
on only blocks of different components are compared, so that a group of near copies costs as many
comparisons as it has members. Every pair that may link and isn't connected already is verified: first
on parity signatures (bits in which two differ are at most the shingles in which the sets differ, so
no link is lost; a set has as many bits as shingles, up to a power of two), then on whole sets, made
from the two texts. Shingles are 64-bit hashes, classes 128-bit ones.

Only shingles of more than one class are listed: a Bloom filter of those, of a bounded size, tells; what
it lets pass wrongly stands in a list of its own.

Rarity is estimated from counts of 2**SKETCH_BITS buckets over all documents; the order affects only
speed. Null texts and texts without words have empty sets and link with nothing. Repeated rows are
documents like others; a component of null ids only has a null id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitfilter, minhash
from .common import array_sums, checkpointed, dropped, prepare, shared_dir, slices
from .components import components
from .textkernel import U, mix, words

SKETCH_BITS = 20
#: 64-bit words of a parity signature at least; a power of two.
LEAST_WORDS = 4
_CLASS = "struct<x:long,y:long>"


def sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and each text's first."""
    h, first = minhash.shingles(words(texts, lower=True), width)
    found = [np.unique(h[a:b]) for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
    return (np.concatenate(found) if found else h), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)


def class_ids(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (U(0x243F6A8885A308D3), U(0x13198A2E03707344)):
        sums = np.concatenate([[U(0)], np.cumsum(mix(h ^ salt), dtype=np.uint64)])
        out.append(mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(U)))
    return out[0], out[1]


def parities(h: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per set, for each bit of its signature whether an odd number of its shingles fall on it; lists of words."""
    size = np.diff(first)
    held = np.exp2(np.ceil(np.log2(np.maximum(size, 64 * LEAST_WORDS) / 64))).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(held)])
    place = np.repeat(edge[:-1] * 64, size) + (mix(h + U(0xA0761D6478BD642F)) & np.repeat(held * 64 - 1, size).astype(U)).astype(np.int64)
    odd = np.bincount(place, minlength=int(edge[-1]) * 64) & 1
    return pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)))


def differing(a: str, b: str) -> Column:
    """Bits in which two signatures differ, the longer one folded to the length of the shorter."""
    n = f"least(size({a}), size({b}))"
    word = lambda p: f"aggregate(sequence(j, size({p}) - 1, {n}), 0L, (s, i) -> s ^ {p}[i])"
    return F.expr(f"aggregate(sequence(0, {n} - 1), 0, (d, j) -> d + bit_count({word(a)} ^ {word(b)}))")


def _struct(x: np.ndarray, y: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["x", "y"])


def rarity(docs: DataFrame, width: int) -> np.ndarray:
    """Documents per bucket of shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in slices(batches, "text"):
            counts += np.bincount((sets(batch.column("text"), width)[0] >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array([counts.astype(np.uint32).tobytes()], pa.binary())], names=["v"])

    sums = array_sums(docs.select("text").mapInArrow(rows, "v binary"), [np.uint32], lambda x: [x[0].astype(np.int64)])
    return sums[0] if sums else np.zeros(1 << SKETCH_BITS, np.int64)


def described(docs: DataFrame, counts: np.ndarray, width: int, num: int, den: int) -> DataFrame:
    """Per document: size, cid, prefix (shingles in order of rarity) and parity beside all columns but text."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 24) - 1).astype(np.uint32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = sets(batch.column("text"), width)
            order = (shared.value[h >> U(64 - SKETCH_BITS)].astype(U) << U(40)) | (mix(h) >> U(24))
            size = np.diff(first)
            take = np.where(size > 0, size - -(-size * num // den) + 1, 0)
            prefix = [h[a:b][np.argsort(order[a:b], kind="stable")[:k]] for a, b, k in zip(first.tolist(), first[1:].tolist(), take.tolist(), strict=False)]
            flat = np.concatenate(prefix) if prefix else h
            edge = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in batch.schema.names if k != "text"), pa.array(size, pa.int64()), _struct(*class_ids(h, first)), pa.ListArray.from_arrays(pa.array(edge), pa.array(flat.view(np.int64))), parities(h, first)], names=[*(k for k in batch.schema.names if k != "text"), "size", "cid", "prefix", "parity"])

    plain = docs.drop("text").schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain), "size long", f"cid {_CLASS}", "prefix array<long>", "parity array<long>"])
    return docs.mapInArrow(rows, schema)


def verified(docs: DataFrame, signed: DataFrame, pairs: DataFrame, folder: str, name: str, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b of class ids) whose whole sets link; docs is read again for a text of each class in pairs.

    signed: cid, size and parity of all classes.
    """
    pairs = pairs.select("a", "b").distinct()
    for s in "ab":
        pairs = pairs.join(signed.select(F.col("cid").alias(s), F.col("size").alias(f"n{s}"), F.col("parity").alias(f"p{s}")), s)
    pairs = checkpointed(pairs.where(differing("pa", "pb") * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b"), folder, f"{name}-pairs")
    asked = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitfilter.build(asked.select("cid.x"), "x"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, first = sets(batch.column("text"), width)
            x, y = class_ids(h, first)
            of = np.flatnonzero(bitfilter.passing(shared.value, x) & (np.diff(first) > 0))
            _, once = np.unique(x[of], return_index=True)
            of = of[np.sort(once)]
            yield pa.RecordBatch.from_arrays([_struct(x[of], y[of]), batch.column("text").take(pa.array(of))], names=["cid", "t"])

    def linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            (ha, fa), (hb, fb) = (sets(batch.column(c), width) for c in ("ta", "tb"))
            ends = zip(fa.tolist(), fa[1:].tolist(), fb.tolist(), fb[1:].tolist(), strict=False)
            common = np.array([len(np.intersect1d(ha[i:j], hb[k:m], assume_unique=True)) for i, j, k, m in ends], np.int64)
            link = common * den >= (np.diff(fa) + np.diff(fb) - common) * num
            yield batch.select(["a", "b"]).filter(pa.array(link))

    found = docs.select("text").mapInArrow(rows, f"cid {_CLASS}, t string").groupBy("cid").agg(F.first("t").alias("t"))
    found = checkpointed(found, folder, f"{name}-texts")
    both = pairs.join(found.select(F.col("cid").alias("a"), F.col("t").alias("ta")), "a").join(found.select(F.col("cid").alias("b"), F.col("t").alias("tb")), "b")
    links = checkpointed(both.mapInArrow(linking, pairs.schema), folder, f"{name}-links")
    dropped(spark, folder, f"{name}-texts", f"{name}-pairs")
    return links


def _may_link(num: int, den: int, size_a: str, pos_a: str, size_b: str, pos_b: str) -> Column:
    """Sizes and first common positions allow a link: what is left of either set reaches the overlap needed."""
    a, b = F.col(size_a), F.col(size_b)
    rest = F.least(a - F.col(pos_a), b - F.col(pos_b))
    return (F.least(a, b) * den >= F.greatest(a, b) * num) & (rest * (num + den) >= num * (a + b))


def connected(texts: DataFrame, index: DataFrame, signed: DataFrame, folder: str, width: int, num: int, den: int) -> DataFrame:
    """(node, comp) of classes that link and share a list. index: tok, bucket (of sizes), cid, size, pos (least possible place of a common shingle), maybe parity.

    pos is the least number of the set's shingles that stand in no other listed set; parity, where index has it, is compared within the join.
    """
    # Each class against the hubs of its lists: the least position in each block of sizes.
    hub = index.groupBy("tok", "bucket").agg(F.min(F.struct("pos", "size", "cid")).alias("hub"))
    hubs = hub.select("tok", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket"), F.col("hub.pos").alias("hp"), F.col("hub.size").alias("hs"), F.col("hub.cid").alias("b"))
    first = index.withColumnRenamed("cid", "a").join(hubs, ["tok", "bucket"]).where((F.col("a") != F.col("b")) & _may_link(num, den, "size", "pos", "hs", "hp"))
    links = verified(texts, signed, first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), folder, "hubs", width, num, den)
    linked = components(links, folder, "hub-components")

    # Blocks of different components that positions and sizes don't rule out.
    index = checkpointed(index.join(linked.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), folder, "blocked")
    dropped(texts.sparkSession, folder, "index")
    blocks = index.groupBy("tok", "bucket", "comp").agg(F.min("pos").alias("pos"), F.min("size").alias("low"), F.max("size").alias("high"), F.count("*").alias("n"))
    left, right = (blocks.select("tok", *(F.col(c).alias(f"{c}_{s}") for c in ("bucket", "comp", "pos", "low", "high", "n"))) for s in "ab")
    rest = F.least(F.col("high_a") - F.col("pos_a"), F.col("high_b") - F.col("pos_b"))
    near = left.join(right, "tok").where((F.col("comp_a") < F.col("comp_b")) & (F.col("high_a") * den >= F.col("low_b") * num) & (F.col("high_b") * den >= F.col("low_a") * num) & (rest * (num + den) >= num * (F.col("low_a") + F.col("low_b"))))
    signs = [c for c in ("parity",) if c in index.columns]
    if signs:  # the block of fewer classes is expanded first, and signatures are compared where the other one is
        swap = F.col("n_a") > F.col("n_b")
        near = near.select("tok", *(F.when(swap, F.col(f"{c}_{o}")).otherwise(F.col(f"{c}_{s}")).alias(f"{c}_{s}") for s, o in ("ab", "ba") for c in ("bucket", "comp")))
    near = near.select("tok", "bucket_a", "comp_a", "bucket_b", "comp_b")
    for s in "ab":
        near = near.join(index.select("tok", *(F.col(c).alias(f"{c}_{s}") for c in ("bucket", "comp", "cid", "pos", "size", *signs))), ["tok", f"bucket_{s}", f"comp_{s}"])
    likely = _may_link(num, den, "size_a", "pos_a", "size_b", "pos_b")
    if signs:
        likely &= differing("parity_a", "parity_b") * (num + den) <= (F.col("size_a") + F.col("size_b")) * (den - num)
    second = near.where(likely).select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b"))
    more = verified(texts, signed, second, folder, "blocks", width, num, den)
    dropped(texts.sparkSession, folder, "blocked")
    if more.limit(1).count():
        linked = components(links.unionByName(more), folder, "components")
    return linked


def often(classes: DataFrame, folder: str, column: str) -> np.ndarray:
    """Filter of the entries of a column of lists that more than one class has."""
    found = classes.select(F.explode(column).alias("tok")).groupBy("tok").agg(F.count("*").alias("n")).where("n > 1").select("tok")
    words = bitfilter.build(checkpointed(found, folder, "often"), "tok")
    dropped(classes.sparkSession, folder, "often")
    return words


def listed(classes: DataFrame, folder: str, column: str, num: int, den: int, shared: Broadcast | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (tok, cid, size, *keep, bucket, pos) of the entries of a column of lists that more than one class may have; shared: what often() tells of them."""
    spark = classes.sparkSession
    shared = shared or spark.sparkContext.broadcast(often(classes, folder, column))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), n)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            of = np.flatnonzero(bitfilter.passing(shared.value, flat.view(U)))
            at = pa.array(row[of])
            yield pa.RecordBatch.from_arrays([pa.array(flat[of]), *(batch.column(c).take(at) for c in ("cid", "size", *keep)), pa.array(pos[of].astype(np.int32))], names=["tok", "cid", "size", *keep, "pos"])

    bucket = F.floor(F.log(F.col("size").cast("double")) / float(np.log(den / num))).cast("int")
    kept = "".join(f", {c} {classes.schema[c].dataType.simpleString()}" for c in keep)
    found = classes.select("cid", "size", *keep, column).mapInArrow(rows, f"tok long, cid {_CLASS}, size long{kept}, pos int")
    return checkpointed(found.withColumn("bucket", bucket), folder, "index")


def grouped(docs: DataFrame, folder: str, width: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per row: the columns in keep, doc_id, size, cid; and (node, comp) of the classes that are linked."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(*[c for c in keep or [] if c not in (doc_id, text)], F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = docs.select("text")
    wide = checkpointed(described(docs, rarity(texts, width), width, num, den), folder, "described")
    classes = checkpointed(wide.where("size > 0").groupBy("cid").agg(*[F.first(c).alias(c) for c in ("size", "prefix", "parity")]), folder, "classes")
    told = checkpointed(wide.drop("prefix", "parity"), folder, "documents")
    dropped(spark, folder, "described")
    index = listed(classes, folder, "prefix", num, den)
    linked = connected(texts, index, classes.select("cid", "size", "parity"), folder, width, num, den)
    dropped(spark, folder, "classes")
    return told, linked


def by_component(told: DataFrame, linked: DataFrame, folder: str, best: Column) -> DataFrame:
    """(cid, best) of every class: the least of a column over its component's rows.

    Both sides of the joins are tables, so that a component or class of many rows can be split among tasks.
    """
    own = told.where("size > 0").groupBy("cid").agg(F.min(best).alias("best"))
    own = checkpointed(own.join(linked.withColumnRenamed("node", "cid"), "cid", "left"), folder, "class-best")
    least = checkpointed(own.where("comp is not null").groupBy("comp").agg(F.min("best").alias("least")), folder, "least")
    found = checkpointed(own.join(least, "comp", "left").select("cid", F.coalesce("least", "best").alias("best")), folder, "best")
    dropped(told.sparkSession, folder, "class-best", "least")
    return found


def digests(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, folder: str | None = None) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id of its component)."""
    folder = folder or shared_dir(docs.sparkSession)
    told, linked = grouped(docs.select("doc_id", "text"), folder, width, num, den)
    best = by_component(told, linked, folder, F.col("doc_id"))
    return told.join(best, "cid", "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("best")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """docs with one row of each component: that of the least doc_id (null last; ties: least hash of the text, then any of equal rows).

    Rows with empty sets link with nothing and all stay.
    """
    names, folder = docs.columns, folder or shared_dir(docs.sparkSession)
    keyed = docs.withColumns({"__d": F.col(doc_id), "__t": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    told, linked = grouped(keyed.select("__d", "__t", F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), folder, width, num, den, keep=["__d", "__t"])
    order = F.struct(F.col("__d").isNull().alias("none"), F.col("__d").alias("d"), F.col("__t").alias("t"))
    best = by_component(told, linked, folder, order)
    rows = told.groupBy("__d", "__t").agg(F.first("cid").alias("cid"), F.first("size").alias("size"), F.count("*").alias("n")).join(best, "cid", "left")
    kept = rows.where((F.col("size") == 0) | order.eqNullSafe(F.col("best"))).select(F.col("__d").alias("__kd"), F.col("__t").alias("__kt"), ((F.col("size") > 0) & (F.col("n") > 1)).alias("__again"))
    joined = keyed.join(kept, F.col("__d").eqNullSafe(F.col("__kd")) & (F.col("__t") == F.col("__kt")))
    once = joined.where("__again").dropDuplicates(["__d", "__t"])  # first rows are combined before the shuffle
    return joined.where(~F.col("__again")).unionByName(once).select(*names)
