"""Language ID by language-bitmask n-gram filters.

A bit-sliced Bloom filter has one bit for each language in every slot. An n-gram (four bytes of
lower-cased text, white space and other ASCII but letters as one space) reads K slots; the AND of
their masks names all languages that hold it. Counts of each language's bits over a whole text, less
what chance hits would give, decide.

The classifier is fitted on a bounded sample: of each language's labelled rows all, or an equal
share chosen by a hash of doc_id and text that gives about `sample` rows; n-grams are counted over
their whole texts.

Texts that are null or hold no letter are `und` with score 0; a text with letters but no known
n-gram is the language with most labelled rows, with score 0; ties go to the language first in
order. Rows without a language aren't learned from; no labelled rows at all: every text is `und`.
Repeated rows are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices
from .textkernel import raw_bytes

SLOTS_BITS, HASHES = 20, 3
SAMPLE = 3_000
#: A language holds an n-gram seen at least this often in its sample, at this share of the highest rate at least.
MIN_COUNT, MIN_SHARE = 3, 0.5
UND = "und"
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = _FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 256)
#: Multipliers of the slots' hashes: fixed odd numbers.
_MULTIPLIERS = [np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917)]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte n-grams of texts in a row, as numbers, and each text's first; runs of spaces are one space."""
    folded = _FOLD[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    before = np.concatenate([[0], np.cumsum(keep)])
    x = folded[keep].astype(np.uint32)
    first = before[offsets]
    n = max(0, len(x) - 3)
    g = x[:n] | x[1 : n + 1] << np.uint32(8) | x[2 : n + 2] << np.uint32(16) | x[3 : n + 3] << np.uint32(24)
    whole = np.ones(n, bool)
    for k in (1, 2, 3):  # n-grams that would reach into the next text
        edge = first[1:-1] - k
        whole[edge[(edge >= 0) & (edge < n)]] = False
    kept = np.concatenate([[0], np.cumsum(whole)])
    return g[whole], kept[np.minimum(first, n)]


def slots(g: np.ndarray) -> list[np.ndarray]:
    mixed = g ^ (g >> np.uint32(15))
    return [(mixed * m) >> np.uint32(32 - SLOTS_BITS) for m in _MULTIPLIERS[:HASHES]]


@dataclass
class Model:
    """Languages in order; masks[slot, word] are the bits of 8 languages a word; chance: each language's false-hit rate."""

    languages: list[str]
    masks: np.ndarray
    chance: np.ndarray
    usual: int

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: best language's index and its score, the text's n-grams, and the share of them that the best language holds."""
        data, offsets = raw_bytes(texts)
        g, first = grams(data, offsets)
        k, total = len(self.languages), np.diff(first)
        hits = np.zeros((len(texts), k))
        if len(g):
            places = slots(g)
            for word in range(self.masks.shape[1]):
                mask = self.masks[places[0], word]
                for p in places[1:]:
                    mask &= self.masks[p, word]
                for bit in range(min(8, k - 8 * word)):
                    seen = np.concatenate([[0], np.cumsum((mask >> np.uint8(bit)) & np.uint8(1), dtype=np.int64)])
                    hits[:, 8 * word + bit] = np.diff(seen[first])
        expected = total[:, None] * self.chance
        true = np.maximum(0, (hits - expected) / np.maximum(1e-9, 1 - self.chance))
        best = true.argmax(axis=1) if k else np.zeros(len(texts), np.int64)
        sums = true.sum(axis=1)
        best[sums <= 0] = self.usual
        top = true[np.arange(len(texts)), best] if k else np.zeros(len(texts))
        return best, np.where(sums > 0, top / np.maximum(sums, 1e-9), 0.0), total, top / np.maximum(total, 1)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Model of the languages in labelled; the driver gets counts of the sample's n-grams only."""
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("h")).where("lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << SLOTS_BITS, 1), np.uint8), np.zeros(0), 0)
    share = F.create_map(*[F.lit(x) for s in languages for x in (s, min(1.0, sample / sizes[s]))])
    chosen = rows.where(F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", "text")
    index = {s: i for i, s in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in slices(batches, "text"):
            g, first = grams(*raw_bytes(batch.column("text")))
            of = np.repeat([index[x] for x in batch.column("lang").to_pylist()], np.diff(first)).astype(np.uint64)
            k, c = np.unique(of << np.uint64(32) | g.astype(np.uint64), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys.astype(np.int64)), "n": pa.array(counts)})

    counted = chosen.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT).toPandas()
    key, n = counted["key"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    of, g = key >> 32, (key & 0xFFFFFFFF).astype(np.uint32)
    rate = n / np.maximum(1, np.bincount(of, weights=n, minlength=len(languages)))[of]
    kinds, at = np.unique(g, return_inverse=True)
    highest = np.zeros(len(kinds))
    np.maximum.at(highest, at, rate)
    held = rate >= MIN_SHARE * highest[at]
    masks = np.zeros((1 << SLOTS_BITS, -(-len(languages) // 8)), np.uint8)
    for i in range(len(languages)):
        for p in slots(g[held & (of == i)]):
            masks[p, i // 8] |= np.uint8(1 << i % 8)
    fill = np.array([((masks[:, i // 8] >> np.uint8(i % 8)) & 1).mean() for i in range(len(languages))])
    return Model(languages, masks, fill**HASHES, max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i)))


def predict(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score", evidence: tuple[str, str] | None = None) -> DataFrame:
    """docs with lang_pred and score; clashing columns are replaced. The model is of a fixed size and is broadcast.

    evidence names two more columns: the text's number of n-grams, and the share of them that the
    predicted language holds. The score compares languages, the share doesn't depend on how many there are.
    """
    spark = docs.sparkSession
    prepare(spark)
    more = {lang_pred: "string", score: "double", **(dict(zip(evidence, ("long", "double"), strict=True)) if evidence else {})}
    docs = docs.drop(*more)
    schema = docs.select("*", *[F.lit(None).cast(v).alias(k) for k, v in more.items()]).schema
    shared = spark.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UND], dtype=object)
        for batch in slices(batches, text):
            col = batch.column(text)
            best, scores, grams_, known = shared.value.scores(col)
            lettered = pa.compute.match_substring_regex(col, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False) & bool(shared.value.languages)
            told = [pa.array(names[np.where(lettered, best, len(names) - 1)], pa.string()), pa.array(np.where(lettered, scores, 0.0)), pa.array(grams_, pa.int64()), pa.array(np.where(lettered, known, 0.0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *told[: len(more)]], names=schema.names)

    return docs.mapInArrow(rows, schema)


