"""The named reads of the access layer, over DataFrames of its tables.

Limits are the reads' own. Sorted reads have `place`, which starts at 1; ties go by the table's key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L

#: Stages in the order of what may be funded, the least first.
STAGE_ORDER = (
    L.STAGE_UNKNOWN, "Closed", "Pleadings", "Motion to dismiss", "Discovery", "Class certification", "Summary judgment", "Active litigation", "Enforcement action",
    "Trial", "Verdict returned", "Post-trial motions", "On appeal", "Judgment proposed", "Judgment entered", "Plan confirmation", "Settlement talks",
    "Settlement reached", "Settlement — preliminary approval", "Settlement — final approval",
)


def ordered(col: Column, values: Sequence[str]) -> Column:
    """Place of a value in an order, from 0; others come last."""
    out = F.lit(len(values))
    for i, v in enumerate(values):
        out = F.when(col == v, i).otherwise(out)
    return out


def stage_rank(stage: Column) -> Column:
    return ordered(stage, STAGE_ORDER)


def first(rows: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows in an order with their place; the window sees the limited rows only."""
    return rows.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


def alerts(table: DataFrame, status: str | None = None) -> DataFrame:
    return table.where(F.col("status") == status) if status else table


def unprocessed_webhooks(table: DataFrame, limit: int = 500) -> DataFrame:
    return first(table.where("processed_at is null"), [F.asc("received_at"), F.asc("idempotency_key")], limit)


def low_coverage_courts(table: DataFrame, limit: int = 40) -> DataFrame:
    return first(table.where(F.col("confidence").isin("low", "partial")), [F.asc("confidence"), F.asc("court_id")], limit)


def all_court_coverage(table: DataFrame) -> DataFrame:
    """Every court with its place from the worst confidence to the best; courts are few at any scale."""
    order = [ordered(F.col("confidence"), ("low", "partial", "high")), F.asc("court_id")]
    return table.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


def open_batches(table: DataFrame) -> DataFrame:
    return table.where("status = 'submitted'").select("batch_id")


def batch_custom_id_map(items: DataFrame) -> DataFrame:
    return items.select(custom_id(F.col("item_uid")).alias("custom_id"), "item_uid")


def custom_id(uid: Column) -> Column:
    """Name of an item in a batch: the first 60 characters of its uid."""
    return F.substring(uid, 1, 60)


def extractions(extracted: DataFrame, items: DataFrame, include_excluded: bool = False) -> DataFrame:
    rows = extracted if include_excluded else extracted.where("not coalesce(is_excluded, false)")
    return rows.join(items.select("item_uid", "source_id", "source_url", "title", "published_at"), "item_uid")


def top_prospects(ranked: DataFrame, limit: int = 100, include_duplicates: bool = False) -> DataFrame:
    rows = ranked.where("not coalesce(is_excluded, false)")
    return first(rows if include_duplicates else rows.where("is_primary"), [F.desc("score"), F.asc("item_uid")], limit)


def recent_items(items: DataFrame, limit: int = 50, source_id: str | None = None) -> DataFrame:
    rows = items.where(F.col("source_id") == source_id) if source_id else items
    return first(rows, [F.desc("published_at"), F.asc("item_uid")], limit)


def enrollments(table: DataFrame, status: str | None = None, limit: int = 200) -> DataFrame:
    """Of one status the best first; of all, confirmed before enrolled before candidates."""
    if status:
        return first(table.where(F.col("status") == status), [F.desc("score_hint"), F.desc("added_at"), F.asc("index_number")], limit)
    return first(table, [ordered(F.col("status"), ("confirmed", "enrolled", "candidate")), F.desc("score_hint"), F.asc("index_number")], limit)


def claims_assignments(items: DataFrame, limit: int = 500) -> DataFrame:
    """Assignments out of items' payloads, the latest first and undated ones last."""
    fields = ("court", "case_number", "debtor", "agent_raw", "vendor_id", "date_filed")
    rows = items.where(F.get_json_object("payload_json", "$.record_kind") == "claims_assignment").select(*[F.get_json_object("payload_json", f"$.{f}").alias(f) for f in fields])
    return first(rows, [F.desc_nulls_last("date_filed"), F.desc("case_number")], limit)


def source_rows(table: DataFrame) -> DataFrame:
    return table.select("source_id", "display_name", "tier", "status", "base_confidence", "enabled", "health", "consecutive_failures")


def last_run(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max_by(F.struct(*runs.columns), F.struct("started_at", "run_id")).alias("r")).where("r is not null").select("r.*")


def count_items(items: DataFrame, source_id: str | None = None) -> DataFrame:
    return (items.where(F.col("source_id") == source_id) if source_id else items).agg(F.count("*").alias("n"))


def pending_tasks(tasks: DataFrame, run_id: str) -> DataFrame:
    return tasks.where((F.col("run_id") == run_id) & F.col("status").isin("PENDING", "RUNNING", "FAILED"))


def run_tasks(tasks: DataFrame, run_id: str) -> DataFrame:
    return tasks.where(F.col("run_id") == run_id)


def consecutive_failures(sources: DataFrame) -> DataFrame:
    return sources.select("source_id", F.coalesce("consecutive_failures", F.lit(0)).alias("consecutive_failures"))


def get_watermark(marks: DataFrame, source_id: str, task_key: str) -> DataFrame:
    """value and seen_keys (an array; empty if there are none or they can't be read) of a task."""
    seen = F.coalesce(F.from_json("seen_keys", "array<string>", {"mode": "PERMISSIVE"}), F.array().cast("array<string>"))
    return marks.where((F.col("source_id") == source_id) & (F.col("task_key") == task_key)).select("value", seen.alias("seen_keys"))


def funnel(items: DataFrame, screened: DataFrame, extracted: DataFrame, prospects: DataFrame) -> DataFrame:
    """One row of counts along the funnel. screened: item_uid, verdict; extracted: item_uid, is_excluded; prospects: item_uid."""
    marks = screened.select("item_uid", "verdict").join(extracted.select("item_uid", F.coalesce("is_excluded", F.lit(False)).alias("gone")), "item_uid", "full").join(prospects.select("item_uid", F.lit(True).alias("ranked")), "item_uid", "full")
    rows = items.select("item_uid", F.lit(True).alias("item")).join(marks, "item_uid", "full")
    n = lambda c: F.count_if(c)
    return rows.agg(
        n(F.col("item")).alias("items"), n(F.col("verdict").isNotNull()).alias("screened_out"), n(F.col("verdict") == "excluded").alias("excluded"), n(F.col("verdict") == "no_signal").alias("no_signal"),
        n(F.col("gone").isNotNull()).alias("extracted"), n(F.col("gone")).alias("extraction_excluded"), n(F.col("ranked")).alias("ranked"), n(F.col("item") & F.col("gone").isNull() & F.col("verdict").isNull()).alias("awaiting"),
    )


#: Columns that a view is filtered by, and those whose text is searched; what a view lacks is left out.
FACETS = ("deal_thesis", "event_type", "practice_area", "stage", "court_group", "band", "source_id", "venue", "is_public")
FIELDS = ("case_caption", "title", "summary", "description", "court", "venue", "jurisdiction", "stage", "deal_thesis", "event_type", "practice_area", "source_id", "docket_number", "counsel", "collectability_note")


def faceted(rows: DataFrame, chosen: Mapping[str, Sequence], text: str = "") -> DataFrame:
    """Rows with one of the chosen values in every facet, and all words of a text somewhere in their fields."""
    for name, values in chosen.items():
        if name not in FACETS:
            raise KeyError(f"{name} is no facet; there are {', '.join(FACETS)}")
        if values:
            rows = rows.where(F.col(name).isin(*values))
    blob = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in FIELDS if c in rows.columns]))
    for word in text.lower().split():
        rows = rows.where(F.contains(blob, F.lit(word)))
    return rows


def facet_counts(rows: DataFrame, chosen: Mapping[str, Sequence], text: str, facet: str) -> DataFrame:
    """Rows for each value of a facet under all other choices."""
    return faceted(rows, {k: v for k, v in chosen.items() if k != facet}, text).groupBy(F.col(facet).alias("value")).agg(F.count("*").alias("n"))


# --- Roll-ups and display ------------------------------------------------------------------------
def roll_up(outcomes: DataFrame) -> DataFrame:
    """Per run of outcomes (run_id, verdict, rows_new, is_partial): what is new, failed and partial, and whether all went well."""
    failed = F.col("verdict") == "BROKEN"
    return outcomes.groupBy("run_id").agg(F.sum("rows_new").alias("total_new"), F.count_if(failed).alias("failures"), F.count_if("is_partial").alias("partials"), F.bool_and(~failed).alias("ok"))


def gaps(prospects: DataFrame, courts: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: imputed prospects and their share, dark and partial venues, broken sources."""
    p = prospects.agg(F.count_if("damages_imputed").alias("imputed"), F.round(F.avg(F.col("damages_imputed").cast("double")), 6).alias("imputed_share"))
    c = courts.agg(F.count_if(F.col("confidence") == "low").alias("dark_venues"), F.count_if(F.col("confidence") == "partial").alias("partial_venues"))
    s = sources.agg(F.count_if(~F.col("health").isin("HEALTHY", "unknown")).alias("broken_sources"))
    one = lambda df: df.withColumn("__one", F.lit(1))  # noqa: E731  each is a single row
    return one(p).join(one(c), "__one").join(one(s), "__one").drop("__one")


def counsel(firms: Column, schema_version: Column) -> Column:
    """Named firms, or whether the document names none or was read before firms were."""
    named = F.filter(F.coalesce(firms, F.array().cast("array<string>")), lambda x: x != "")
    return F.when(F.size(named) > 0, F.array_join(named, "; ")).when(F.coalesce(schema_version, F.lit(1)) >= 2, "not named in document").otherwise("not captured (pre-v2 extraction)")


def display(rows: DataFrame) -> DataFrame:
    """rows with document_count, court_display and damages_sort_key."""
    return rows.withColumns({"document_count": F.col("cluster_size").cast("long"), "court_display": F.trim(F.coalesce(F.nullif(F.trim("court"), F.lit("")), F.col("venue"), F.lit(""))), "damages_sort_key": F.coalesce("damages_usd", F.lit(0.0))})


#: Columns that a view may be sorted by; text sorts in its own order, missing counsel last.
SORTS = {
    "rank": F.col, "score": F.col, "case": lambda _: F.lower("case_caption"), "stage": lambda _: stage_rank(F.col("stage")), "venue": lambda _: F.lower("venue"), "damages": lambda _: F.coalesce("damages_usd", F.lit(0.0)),
    "band": lambda _: F.coalesce("damages_usd", F.lit(-1.0)), "thesis": lambda _: F.col("deal_thesis"), "event": lambda _: F.col("event_type"), "date": lambda _: F.col("event_date"),
    "counsel": lambda _: F.when(F.col("counsel").startswith("not "), "￿").otherwise(F.lower("counsel")),
}


def sorted_view(rows: DataFrame, key: str, descending: bool, limit: int) -> DataFrame:
    """The first rows by a chosen column, ties by rank."""
    by = SORTS[key]({"rank": "rank_in_run"}.get(key, key))
    return first(rows, [by.desc_nulls_last() if descending else by.asc_nulls_last(), F.asc("rank_in_run")], limit)
