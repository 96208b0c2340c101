"""Streams of items: key-state deduplication without dropping late rows, commits by batch, webhook drain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.store import VersionedStore, insert_ignore


def files(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).load(folder)


def first_of_key(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's first row, however late it comes: keys are state, event time drops nothing."""
    return stream.dropDuplicates(keys)


def commit_batch(batch: DataFrame, store: VersionedStore, keys: tuple[str, str] = ("source_id", "natural_key")) -> None:
    """Add a batch's new items and advance their sources' watermarks, in one commit.

    A source with rows of status BROKEN adds nothing in this batch: all its rows are kept as `pending` in
    the same commit, and those that aren't BROKEN themselves are added by the next batch in which their
    source is sound, whether or not it has rows there. A BROKEN row waits until a sound one of its key
    comes. Redone batches change nothing, as known keys are ignored and pending rows are kept once.
    """
    waiting = store.read("pending")
    rows = batch if waiting is None else batch.unionByName(waiting.select(*batch.columns))
    broken = batch.where("status = 'BROKEN'").select("source_id").distinct()
    whole = F.coalesce(F.col("status"), F.lit("OK")) != "BROKEN"
    fine = rows.where(whole).join(broken, "source_id", "left_anti").drop("status").dropDuplicates(list(keys))
    old = store.read("item")
    new = fine if old is None else insert_ignore(old, fine, list(keys))
    refused = rows.where(whole).join(broken, "source_id", "left_semi").unionByName(rows.where(~whole).join(fine.select(*keys), list(keys), "left_anti").select(*rows.columns))
    marks = fine.groupBy("source_id").agg(F.max("published_at").alias("value"))
    before = store.read("watermark")
    if before is not None:
        marks = marks.unionByName(before).groupBy("source_id").agg(F.max("value").alias("value"))
    pending = refused.select(*batch.columns).dropDuplicates([*keys, "status"])
    store.commit({"watermark": marks, "pending": pending}, append={"item": new})


def commit_items(stream: DataFrame, store: VersionedStore, checkpoint: str, keys: tuple[str, str] = ("source_id", "natural_key"), most_folders: int = 64) -> StreamingQuery:
    """commit_batch for each batch of the stream; only new items are written, and folders are merged when there are many."""

    def commit(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            commit_batch(batch, store, keys)
        finally:
            batch.unpersist()
        if len(store.manifest()["item"]) > most_folders:
            store.compact("item")

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def look_back(items: DataFrame, days: int, as_of: str) -> DataFrame:
    """Items of the last days, which a run reads again; known keys are ignored when they are added."""
    return items.where(F.col("published_at") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp"))


def drain(queue: DataFrame, watched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of unprocessed webhook rows, and the marks (idempotency_key, process_error) of all of them.

    A row without a docket, or with one that nobody watches, makes no item and is marked with the reason.
    """
    known = watched.select("docket_id", F.lit(True).alias("__watched")).dropDuplicates(["docket_id"])
    rows = queue.where("processed_at is null").join(known, "docket_id", "left")
    error = F.when(F.col("docket_id").isNull(), "no docket id in the payload").when(F.col("__watched").isNull(), "docket is not subscribed")
    told = rows.withColumn("process_error", error)
    items = told.where("process_error is null").select(F.lit("webhook").alias("source_id"), F.concat(F.lit("docket:"), F.col("docket_id").cast("string"), F.lit(":"), "idempotency_key").alias("natural_key"), "docket_id", "payload_json")
    return items, told.select("idempotency_key", "process_error")


def webhook_rows(raw: DataFrame) -> DataFrame:
    """Queue rows of webhook bodies (body, header_key): an idempotency key, the event's type and its docket."""
    number = lambda path: F.get_json_object("body", path).try_cast("long")
    docket = F.coalesce(*[number(p) for p in ("$.payload.docket", "$.payload.docket_id", "$.payload.results[0].docket", "$.payload.results[0].docket_id", "$.docket_id")])
    key = F.coalesce(F.nullif("header_key", F.lit("")), F.concat(F.lit("sha256:"), F.sha2("body", 256)))
    return raw.select(key.alias("idempotency_key"), F.get_json_object("body", "$.webhook.event_type").try_cast("int").alias("event_type"), docket.alias("docket_id"), F.col("body").alias("payload_json"))


def hourly(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Counts per source and hour; here, where only sums are wanted, rows later than lateness may go."""
    return stream.withWatermark("ts", lateness).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
