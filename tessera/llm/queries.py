"""The operators' queries: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bands, bpe, decontaminate, jaccard, langid, maxent, oracles, substring, token_files, urlfilter, warc
from .common import held_out, shared_dir, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), ["page_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"), shared_dir(spark)))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return maxent.score(docs.withColumn("training", ~held_out("doc_id", 7, 2)))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digests(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 5, 0))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_files": op2_token_files,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_minhash": op10_minhash,
}

#: Only what SQL can say of whole tables.
ORACLE_SQL: dict[str, str] = dict(oracles.SQL)
