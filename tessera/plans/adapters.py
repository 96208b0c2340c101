"""Views of the star schema as document events: items, extractions, health, alerts, claims, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import item_uid

#: Texts of the synthetic items, by o_orderkey.
PHRASES = (
    "proposed final judgment and competitive impact statement filed", "entry of judgment after trial", "jury verdict for the plaintiff", "proposed jury verdict form",
    "notice of appeal from the final judgment", "supersedeas bond posted", "final approval of the class deal", "notice of settlement with the insurer",
    "settlement agreement in the price-fixing matter", "antitrust inquiry opened under the sherman act", "patent infringement suit", "uncitral award confirmed",
    "robocall class under the tcpa", "civil forfeiture of funds", "superseding indictment unsealed", "indictment for bid-rigging", "chapter 11 plan of reorganization",
    "breach of contract and fraud claims", "routine status report", "motion to dismiss under rule 12(b)(6)", "discovery and deposition schedule", "mediation set for spring",
    "summary judgment argued", "case closed and fully paid",
)
EVENTS = {"1-URGENT": "judgment_entered", "2-HIGH": "settlement_reached", "3-MEDIUM": "jury_verdict", "4-NOT SPECIFIED": "case_filed", "5-LOW": "appeal_filed"}
THESES = {"F": "judgment_monetization", "O": "post_settlement", "P": "antitrust_followon"}
AREAS = {"AUTOMOBILE": "antitrust", "BUILDING": "commercial", "FURNITURE": "bankruptcy", "MACHINERY": "securities", "HOUSEHOLD": "other"}
AS_OF = "2001-09-01 00:00:00"


def _sql_map(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n, r = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # nation and region have 25 and 5 rows at any scale


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_uid, source_id, natural_key, title, body, published_at of each order."""
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("o_orderkey") % len(PHRASES) + 1).cast("int"))
    key = F.col("o_orderkey").cast("string")
    return _parties(spark, sf_dir).select(item_uid(F.col("r_name"), key).alias("item_uid"), F.col("r_name").alias("source_id"), key.alias("natural_key"), F.col("c_name").alias("title"), F.concat(F.lit("Order "), key, F.lit(": "), phrase).alias("body"), F.col("o_orderdate").alias("published_at"))


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an extractor would say of each order."""
    key = F.col("o_orderkey").cast("string")
    return _parties(spark, sf_dir).select(
        item_uid(F.col("r_name"), key).alias("item_uid"), F.col("r_name").alias("source_id"), F.col("c_name").alias("title"),
        F.concat(F.lit("Acme Holdings v. "), F.col("c_name"), F.when(F.col("o_orderkey") % 7 == 0, ", et al.").otherwise("")).alias("case_caption"),
        F.lit(None).cast("string").alias("docket_number"), F.expr(_sql_map("o_orderstatus", THESES)).alias("deal_thesis"), F.expr(_sql_map("o_orderpriority", EVENTS)).alias("event_type"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") * 1000).alias("damages_usd"), F.lit("medium").alias("damages_conf"),
        F.col("o_orderdate").alias("event_date"), F.col("o_orderdate").alias("published_at"), (F.col("c_acctbal") > 5000).alias("is_public"),
        F.when(F.col("o_orderkey") % 5 == 0, "insolvent debtor").when(F.col("o_orderkey") % 5 == 1, "bond posted").alias("collectability_note"),
        F.when(F.col("o_orderkey") % 6 == 0, F.concat(F.lit("Court of Chancery, Delaware, "), "n_name")).when(F.col("o_orderkey") % 6 == 1, F.concat(F.lit("Southern District of New York, "), "n_name")).otherwise(F.col("n_name")).alias("venue"), F.lit("").alias("court"), F.lit("").alias("jurisdiction"), F.expr(_sql_map("c_mktsegment", AREAS)).alias("practice_area"), F.lit("high").alias("practice_conf"),
        F.lit(0.8).alias("source_confidence"), (F.col("o_orderpriority") != "5-LOW").alias("has_stated_damages"),
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and hour a run: rows parsed and new."""
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("source_id"), F.date_trunc("hour", "ts").alias("observed_at")).agg(F.count("*").alias("rows_parsed"), F.count_if(F.col("value") > 100).alias("rows_new"), F.min("event_id").alias("run_id"))


PARTIES_SQL = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
ITEMS_SQL = (
    "SELECT sha256(r_name || chr(0) || CAST(o_orderkey AS VARCHAR)) AS item_uid, r_name AS source_id, CAST(o_orderkey AS VARCHAR) AS natural_key, c_name AS title, "
    f"'Order ' || CAST(o_orderkey AS VARCHAR) || ': ' || ([{', '.join(repr(p) for p in PHRASES)}])[CAST(o_orderkey % {len(PHRASES)} + 1 AS INT)] AS body, o_orderdate AS published_at FROM {PARTIES_SQL}"
)
EXTRACTIONS_SQL = (
    "SELECT sha256(r_name || chr(0) || CAST(o_orderkey AS VARCHAR)) AS item_uid, r_name AS source_id, c_name AS title, "
    "'Acme Holdings v. ' || c_name || CASE WHEN o_orderkey % 7 = 0 THEN ', et al.' ELSE '' END AS case_caption, "
    f"{_sql_map('o_orderstatus', THESES)} AS deal_thesis, {_sql_map('o_orderpriority', EVENTS)} AS event_type, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 1000 END AS damages_usd, o_orderdate AS event_date, c_acctbal > 5000 AS is_public, "
    "CASE WHEN o_orderkey % 5 = 0 THEN 'insolvent debtor' WHEN o_orderkey % 5 = 1 THEN 'bond posted' END AS collectability_note, "
    "CASE o_orderkey % 6 WHEN 0 THEN 'Court of Chancery, Delaware, ' || n_name WHEN 1 THEN 'Southern District of New York, ' || n_name ELSE n_name END AS venue, "
    f"{_sql_map('c_mktsegment', AREAS)} AS practice_area, o_orderpriority <> '5-LOW' AS has_stated_damages FROM {PARTIES_SQL}"
)
HEALTH_SQL = "SELECT event_type AS source_id, date_trunc('hour', ts) AS observed_at, count(*) AS rows_parsed, count(*) FILTER (WHERE value > 100) AS rows_new, min(event_id) AS run_id FROM events GROUP BY 1, 2"
