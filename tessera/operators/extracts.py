"""Requests to an extractor and its results, screens of what it says, and the worklist of matters to enroll."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..sources.spool import index_number
from .access import custom_id


def prompt(rows: DataFrame, system: str) -> DataFrame:
    """custom_id, system and user text of each candidate (item_uid, title, body, source_url, source_id, thesis, hints array)."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit(""))) for k, v in (("Source", F.col("source_id")), ("URL", F.col("source_url")), ("Title", F.col("title")), ("Signal", F.col("thesis")), ("Practice areas", F.array_join("hints", ", ")))]
    return rows.select(custom_id(F.col("item_uid")).alias("custom_id"), F.lit(system).alias("system"), F.concat_ws("\n", *lines, F.lit(""), F.coalesce("body", F.lit(""))).alias("user"))


def requests(prompts: DataFrame, model: str, max_tokens: int) -> DataFrame:
    """A line of JSON for each prompt; written as text they are a batch to be submitted by whoever has the network."""
    params = F.struct(F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), F.col("system"), F.array(F.struct(F.lit("user").alias("role"), F.col("user").alias("content"))).alias("messages"))
    return prompts.select(F.to_json(F.struct("custom_id", params.alias("params"))).alias("value"))


def results(lines: DataFrame, items: DataFrame) -> DataFrame:
    """item_uid, custom_id, payload_json and error of a batch's result lines (value), in any order.

    A result is joined to its item by the uid's first 60 characters; one without an item keeps its
    custom_id as uid. A line that isn't JSON, or whose payload isn't, has an error and no payload.
    """
    parsed = lines.select(F.from_json("value", "custom_id string, text string", {"mode": "PERMISSIVE"}).alias("r")).select("r.custom_id", "r.text")
    sound = F.from_json("text", "map<string,string>", {"mode": "PERMISSIVE"}).isNotNull() & F.trim("text").startswith("{")
    told = parsed.where("custom_id is not null").select("custom_id", F.when(sound, F.col("text")).alias("payload_json"), F.when(F.col("text").isNull(), "empty result").when(~sound, "unparsable payload").alias("error"))
    known = items.select(custom_id(F.col("item_uid")).alias("custom_id"), "item_uid").dropDuplicates(["custom_id"])
    return told.join(known, "custom_id", "left").select(F.coalesce("item_uid", "custom_id").alias("item_uid"), "custom_id", "payload_json", "error")


def to_refresh(items: DataFrame, extracted: DataFrame, schema_version: int) -> DataFrame:
    """Items without an extraction, or with one of an older schema."""
    known = extracted.select("item_uid", "schema_version")
    return items.join(known, "item_uid", "left").where(F.coalesce("schema_version", F.lit(0)) < schema_version).drop("schema_version")


def hardened(schema: Mapping[str, Any]) -> dict[str, Any]:
    """A JSON schema all of whose objects have all their properties required and no others allowed."""
    out = {k: hardened(v) if isinstance(v, Mapping) else [hardened(x) if isinstance(x, Mapping) else x for x in v] if isinstance(v, list) else v for k, v in schema.items()}
    if out.get("type") == "object" or "properties" in out:
        out |= {"additionalProperties": False, "required": list(out.get("properties", {}))}
    return out


def late_screen(extracted: DataFrame) -> DataFrame:
    """extracted (case_caption, summary, posture, ...) with late_excluded, late_area and late_reason of what the extractor says."""
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("case_caption", "summary", "posture")])
    rows = classify.with_exclusion(extracted, text, prefix="late_", reasons=True)
    return rows.drop("late_matched")


#: Words of a court's text that tell of a New York state court.
STATE_HINTS = (
    "supreme court of the state of new york", "new york county", "kings county", "westchester county", "nassau county", "suffolk county", "erie county", "n.y. sup", "nyscef",
)


def worklist(prospects: DataFrame, hints: Sequence[str] = STATE_HINTS, limit: int = 25) -> DataFrame:
    """Matters worth enrolling: one row a key (index number, else the caption's first 80 characters), the best first.

    prospects: item_uid, case_caption, title, court, venue, jurisdiction, summary, score. A row with an
    index number scores 0.05 more, as it can be enrolled at once.
    """
    blob = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("case_caption", "court", "venue", "jurisdiction", "summary")]))
    hint = F.lit(None).cast("string")
    for h in reversed(hints):
        hint = F.when(F.contains(F.col("__blob"), F.lit(h)), h).otherwise(hint)
    rows = prospects.withColumn("__blob", blob).withColumn("hint", hint).where("hint is not null")
    rows = rows.withColumn("index_number", index_number(F.concat_ws(" ", F.coalesce("case_caption", F.lit("")), F.coalesce("summary", F.lit("")))))
    caption = F.coalesce(F.nullif("case_caption", F.lit("")), F.col("title"), F.lit(""))
    rows = rows.withColumns({"caption": F.trim(caption), "key": F.coalesce("index_number", F.substring(caption, 1, 80)), "score_hint": F.coalesce("score", F.lit(0.0)) + F.when(F.col("index_number").isNotNull(), 0.05).otherwise(0.0)}).where("key <> ''")
    reason = F.concat(F.lit("NY state signal: "), "hint", F.when(F.col("index_number").isNull(), "; no index number found").otherwise(""))
    best = rows.withColumn("reason", reason).groupBy("key").agg(F.max_by(F.struct("item_uid", "index_number", "caption", "reason", "score_hint"), F.struct("score", "item_uid")).alias("r")).select("key", "r.*")
    order = [F.desc("score_hint"), F.asc("key")]
    return best.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


