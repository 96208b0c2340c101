"""The corpus pipeline: five stages over documents, each written before the next reads it.

Null and empty texts have no letters, so language ID rejects them. Null ids are ids like others: of near
duplicates the least id stays and null is the last; of rows equal in id and text one stays. Very long
texts are worked on whole. Empty tables of documents or benchmark items are fine: without labelled rows
no language is known and every document is rejected. All stages but the last keep the columns of
documents, whatever they are named, and their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, jaccard, langid, substring
from tessera.llm.common import checkpointed, dropped, held_out, shared_dir, table
from tessera.llm.queries import vocabulary

#: A document is rejected if it has no letters, or if it has so many n-grams and no language holds this share of them.
ENOUGH_GRAMS, LEAST_KNOWN = 20, 0.25
#: Near-duplicates: runs of five words, Jaccard 0.8 or more.
WIDTH, SIMILARITY = 5, (80, 100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a language that the labelled ones show; texts too short to judge stay."""
    model = langid.fit(docs.where(~held_out("doc_id", 5, 0)))
    told = langid.predict(docs, model, lang_pred="__lang", score="__score", evidence=("__grams", "__known"))
    foreign = (F.col("__grams") >= ENOUGH_GRAMS) & (F.col("__known") < LEAST_KNOWN)
    return told.where((F.col("__lang") != langid.UND) & ~foreign).drop("__lang", "__score", "__grams", "__known")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one of least doc_id."""
    return jaccard.one_of_each(docs, WIDTH, *SIMILARITY)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words in repeated windows from the texts; n_chars follows the text."""
    return substring.strip(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item is found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, with digests of the ids and of the text decoded from them."""
    import public_tokenizers

    return bpe.digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE encoding and decoding", encoded),
]
#: SQL can't express language ID by a fitted model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = checkpointed(stage(spark, docs, sf_dir), folder, f"stage-{i}")
        dropped(spark, folder, f"stage-{i - 1}")
    return docs
