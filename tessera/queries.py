"""Queries over the driver's tables and the SQL that says the same, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import classify, lexicon as L
from .functions import text as T
from .operators import access, cluster, health, scoring, store
from .plans import adapters as A
from .plans import tasks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(alternatives: tuple[str, ...]) -> str:
    return _text("(?i)" + "|".join(f"(?:{a})" for a in alternatives))


def _has(column: str, alternatives: tuple[str, ...]) -> str:
    return f"regexp_matches({column}, {_re(alternatives)})"


def _case(column: str, values: dict, default: object) -> str:
    shown = lambda v: "NULL" if v is None else _text(v) if isinstance(v, str) else repr(float(v))
    return f"CASE {column} " + " ".join(f"WHEN {_text(k)} THEN {shown(v)}" for k, v in values.items()) + f" ELSE {shown(default)} END"


# --- Score, rank, bands --------------------------------------------------------------------------
_norm = lambda x: f"(CASE WHEN {x} <= 1e5 THEN 0.0 WHEN {x} >= 1e9 THEN 1.0 ELSE (log10({x}) - 5) / 4 END)"
_PARTS_SQL = {
    "thesis_fit": f"({_case('event_type', L.EVENT_FIT, 0.2)}) * ({_case('deal_thesis', L.THESIS_PRIORITY, 0.0)})",
    "damages": f"CASE WHEN damages_usd > 0 THEN {_norm('damages_usd')} * 0.75 ELSE {_norm('(' + _case('deal_thesis', L.THESIS_PRIORS, 5e6) + ')')} * 0.45 END",
    "recency": f"pow(0.5, greatest(0.0, (epoch(TIMESTAMP '{A.AS_OF}') - floor(epoch(event_date))) / 86400.0) / 30)",
    "collectability": "CASE WHEN collectability_note LIKE '%bond%' THEN greatest(CASE WHEN is_public THEN 0.9 ELSE 0.5 END, 0.8) WHEN collectability_note LIKE '%insolven%' THEN 0.25 WHEN is_public THEN 0.9 ELSE 0.5 END",
    "venue": "CASE " + " ".join(f"WHEN contains(lower(venue), '{n}') THEN {float(q)}" for n, q in sorted(L.VENUE_QUALITY.items(), key=lambda x: -x[1]) if q > 0.5) + " ELSE 0.5 END",
    "practice_fit": _case("practice_area", L.PRACTICE_FIT, 0.25),
    "source_confidence": "0.8",
}
_SCORED_SQL = f"SELECT *, round({' + '.join(f'{L.WEIGHTS[k]} * p_{k}' for k in _PARTS_SQL)}, 6) AS score FROM (SELECT *, {', '.join(f'CAST({v} AS DOUBLE) AS p_{k}' for k, v in _PARTS_SQL.items())} FROM ({A.EXTRACTIONS_SQL}))"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(A.extractions(spark, sf_dir), A.AS_OF)


@query(f"SELECT item_uid, {', '.join(f'round(p_{k}, 4) AS {k}' for k in _PARTS_SQL)} FROM ({_SCORED_SQL})")
def score_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("item_uid", *[F.round(f"components.{k}", 4).alias(k) for k in _PARTS_SQL])


_KEY_SQL = "'cap:acme holdings v customer ' || split_part(title, '#', 2)"
_CLUSTERED_SQL = f"""SELECT *, count(*) OVER (PARTITION BY cluster_key) AS cluster_size,
  row_number() OVER (PARTITION BY cluster_key ORDER BY score DESC, has_stated_damages DESC, (event_date IS NOT NULL) DESC, item_uid DESC) = 1 AS is_primary
  FROM (SELECT *, {_KEY_SQL} AS cluster_key FROM ({_SCORED_SQL}))"""
_RANKED_SQL = f"SELECT *, row_number() OVER (ORDER BY score DESC, item_uid) AS rank_in_run FROM ({_CLUSTERED_SQL}) WHERE is_primary"


@query(f"SELECT rank_in_run, item_uid, cluster_key, cluster_size, score FROM ({_RANKED_SQL}) WHERE rank_in_run <= 100")
def top_matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred best matters: score, cluster, rank."""
    heads = cluster.heads(cluster.with_matter(_scored(spark, sf_dir))).orderBy(F.desc("score"), "item_uid").limit(100)
    place = F.row_number().over(Window.orderBy(F.desc("score"), "item_uid")).cast("long")  # of a hundred rows
    return heads.select(place.alias("rank_in_run"), "item_uid", "cluster_key", "cluster_size", "score")


_ALL_RANKED_SQL = f"SELECT *, CASE WHEN is_primary THEN row_number() OVER (PARTITION BY is_primary ORDER BY score DESC, item_uid) END AS rank_in_run FROM ({_CLUSTERED_SQL})"


@query(f"SELECT item_uid, rank_in_run, score FROM ({_ALL_RANKED_SQL})")
def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every matter's rank; other documents of a matter have none."""
    return cluster.ranked(cluster.clustered(_scored(spark, sf_dir))).select("item_uid", "rank_in_run", "score")


@query(f"SELECT item_uid, rank_in_run, score, cluster_key, cluster_size, is_primary, case_caption, title, deal_thesis, event_type, damages_usd, event_date, venue, practice_area FROM ({_ALL_RANKED_SQL})")
def ranked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its matter's rank and all that is shown of it."""
    return cluster.ranked(cluster.clustered(_scored(spark, sf_dir))).select("item_uid", "rank_in_run", "score", "cluster_key", "cluster_size", "is_primary", "case_caption", "title", "deal_thesis", "event_type", "damages_usd", "event_date", "venue", "practice_area")


@query(f"SELECT count(*) AS n_rows, count(DISTINCT cluster_key) AS matters, CAST(sum((is_primary AND cluster_size > 1)::INT) AS BIGINT) AS with_duplicates, count(*) - count(DISTINCT cluster_key) AS absorbed FROM ({_CLUSTERED_SQL})")
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cluster.with_matter(A.extractions(spark, sf_dir)).groupBy("cluster_key").agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("matters"), F.count_if(F.col("n") > 1).alias("with_duplicates"), (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("absorbed"))


@query(f"SELECT cluster_key, item_uid, score FROM ({_CLUSTERED_SQL}) WHERE NOT is_primary AND cluster_key IN (SELECT cluster_key FROM ({_RANKED_SQL}) WHERE rank_in_run <= 20)")
def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other documents of the twenty best matters."""
    rows = cluster.with_matter(_scored(spark, sf_dir))
    shown = cluster.heads(rows).orderBy(F.desc("score"), "item_uid").limit(20).select("cluster_key", F.col("item_uid").alias("primary_uid"))
    return rows.join(F.broadcast(shown), "cluster_key").where("item_uid <> primary_uid").select("cluster_key", "item_uid", "score")  # twenty keys


_BAND_SQL = "CASE WHEN damages_usd IS NULL OR damages_usd <= 0 THEN 'Not stated' " + " ".join(f"WHEN damages_usd < {hi} THEN '{b}'" for b, _, hi in L.SIZE_BANDS[:-1]) + f" ELSE '{L.SIZE_BANDS[-1][0]}' END"


@query(f"SELECT band, count(*) AS n FROM (SELECT {_BAND_SQL} AS band FROM ({A.EXTRACTIONS_SQL})) GROUP BY 1")
def size_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.extractions(spark, sf_dir)
    return rows.groupBy(scoring.size_band(F.col("damages_usd"), F.col("damages_usd").isNull()).alias("band")).agg(F.count("*").alias("n"))


@query(f"""SELECT b.band, count(e.band) AS n FROM (SELECT unnest([{', '.join(_text(b[0]) for b in L.SIZE_BANDS)}, 'Not stated']) AS band) b
  LEFT JOIN (SELECT {_BAND_SQL} AS band FROM ({A.EXTRACTIONS_SQL}) WHERE deal_thesis = 'post_settlement' AND practice_area IN ('antitrust', 'commercial')) e ON e.band = b.band GROUP BY 1""")
def band_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per band under all other filters; bands without rows count zero."""
    rows = A.extractions(spark, sf_dir).where("deal_thesis = 'post_settlement' and practice_area in ('antitrust', 'commercial')")
    counts = rows.groupBy(scoring.size_band(F.col("damages_usd"), F.col("damages_usd").isNull()).alias("band")).agg(F.count("*").alias("n"))
    bands = spark.createDataFrame([(b[0],) for b in L.SIZE_BANDS] + [(L.NOT_STATED,)], "band string")
    return bands.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query(f"SELECT item_uid, title, deal_thesis, practice_area FROM ({A.EXTRACTIONS_SQL}) WHERE deal_thesis IN ('antitrust_followon', 'post_settlement') AND practice_area = 'commercial' AND is_public AND event_type <> 'case_filed' AND contains(lower(concat_ws(' ', case_caption, title, venue, deal_thesis, event_type, practice_area, source_id, collectability_note)), 'nation_1') AND contains(lower(concat_ws(' ', case_caption, title, venue, deal_thesis, event_type, practice_area, source_id, collectability_note)), 'acme')")
def faceted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under four facets that hold two words."""
    chosen = {"deal_thesis": ["antitrust_followon", "post_settlement"], "practice_area": ["commercial"], "is_public": [True], "event_type": [e for e in A.EVENTS.values() if e != "case_filed"]}
    return access.faceted(A.extractions(spark, sf_dir), chosen, "ACME nation_1").select("item_uid", "title", "deal_thesis", "practice_area")


@query(f"SELECT practice_area AS value, count(*) AS n FROM ({A.EXTRACTIONS_SQL}) WHERE deal_thesis = 'post_settlement' AND is_public GROUP BY 1")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of one facet under the choices of the others."""
    return access.facet_counts(A.extractions(spark, sf_dir), {"deal_thesis": ["post_settlement"], "practice_area": ["commercial"], "is_public": [True]}, "", "practice_area")


@query(f"SELECT DISTINCT practice_area, deal_thesis FROM ({A.EXTRACTIONS_SQL})")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.extractions(spark, sf_dir).select("practice_area", "deal_thesis").distinct()


@query(f"""SELECT item_uid, CASE WHEN x IS NULL THEN '' WHEN x >= 1e9 THEN '$' || replace(CAST(CAST(round_even(x / 1e9, 1) AS DECIMAL(18, 1)) AS VARCHAR) || 'B', '.0B', 'B') WHEN x >= 1e6 THEN '$' || CAST(CAST(round_even(x / 1e6, 0) AS BIGINT) AS VARCHAR) || 'M'
  WHEN x >= 1e3 THEN '$' || CAST(CAST(round_even(x / 1e3, 0) AS BIGINT) AS VARCHAR) || 'K' ELSE '$' || format('{{:,}}', CAST(round_even(x, 0) AS BIGINT)) END AS amount FROM (SELECT item_uid, damages_usd * CASE WHEN is_public THEN 31.0 ELSE 0.000003 END AS x FROM ({A.EXTRACTIONS_SQL}))""")
def stated_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts from dollars to billions, and missing ones."""
    amount = F.col("damages_usd") * F.when(F.col("is_public"), 31.0).otherwise(0.000003)
    return A.extractions(spark, sf_dir).select("item_uid", T.money(amount).alias("amount"))


# --- Text classification -------------------------------------------------------------------------
_EVENT_SQL = f"""CASE WHEN proposed THEN 'settlement_proposed' WHEN verdict THEN 'verdict' WHEN entered AND appeal THEN 'appeal' WHEN entered THEN 'judgment_entered' WHEN appeal THEN 'appeal'
  WHEN approved THEN 'settlement_approved' WHEN settled THEN 'settlement_reached' WHEN antitrust THEN 'enforcement' ELSE 'other' END"""
_STRENGTH_SQL = """CASE WHEN proposed THEN CASE WHEN antitrust THEN 0.85 ELSE 0.7 END WHEN verdict THEN 0.9 WHEN entered AND appeal THEN 0.95 WHEN entered THEN 0.8 WHEN appeal THEN 0.6
  WHEN approved THEN 0.8 WHEN settled THEN CASE WHEN antitrust THEN 0.85 ELSE 0.75 END WHEN antitrust THEN 0.4 ELSE 0.0 END"""
_THESIS_SQL = """CASE WHEN proposed THEN CASE WHEN antitrust THEN 'antitrust_followon' ELSE 'post_settlement' END WHEN verdict OR entered OR appeal THEN 'judgment_monetization'
  WHEN approved THEN 'post_settlement' WHEN settled THEN CASE WHEN antitrust THEN 'antitrust_followon' ELSE 'post_settlement' END WHEN antitrust THEN 'antitrust_followon' ELSE 'none' END"""
_FLAGS_SQL = f"""SELECT *, {_has('body', L.PROPOSED_JUDGMENT)} AS proposed, {_has('body', L.VERDICT)} AND NOT {_has('body', L.PROPOSED_VERDICT)} AS verdict, {_has('body', L.JUDGMENT_ENTERED)} AS entered,
  {_has('body', L.APPEAL)} AS appeal, {_has('body', L.SETTLEMENT_APPROVED)} AS approved, {_has('body', L.SETTLEMENT_REACHED)} AS settled, {_has('body', L.ANTITRUST)} AS antitrust FROM ({A.ITEMS_SQL})"""
_CLASSIFIED_SQL = f"SELECT *, {_THESIS_SQL} AS thesis, {_EVENT_SQL} AS event_class, CAST({_STRENGTH_SQL} AS DOUBLE) AS strength FROM ({_FLAGS_SQL})"
_AREA_SQL = f"""CASE WHEN {_has('body', L.IP)} THEN 'intellectual_property' WHEN {_has('body', L.INTL_ARB)} THEN 'international_arbitration' WHEN {_has('body', L.CONSUMER)} THEN 'consumer'
  WHEN {_has('body', L.FORFEITURE)} THEN 'forfeiture' WHEN {_has('body', L.CRIMINAL)} AND NOT {_has('body', L.CRIMINAL_CARVEOUT)} THEN 'criminal' ELSE 'none' END"""


@query(f"SELECT item_uid, thesis, event_class, strength FROM ({_CLASSIFIED_SQL})")
def classify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.with_event(A.items(spark, sf_dir), F.col("body")).select("item_uid", "thesis", "event_class", "strength")


@query(f"""SELECT item_uid, concat_ws(',', CASE WHEN {_has('body', L.ANTITRUST)} THEN 'antitrust' END, CASE WHEN {_has('body', L.BANKRUPTCY)} THEN 'bankruptcy' END, CASE WHEN {_has('body', L.COMMERCIAL)} THEN 'commercial' END) AS hints FROM ({A.ITEMS_SQL})""")
def practice_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.items(spark, sf_dir).select("item_uid", F.array_join(classify.practice_hints(F.col("body")), ",").alias("hints"))


@query(f"SELECT item_uid, area <> 'none' AS excluded, area FROM (SELECT item_uid, {_AREA_SQL} AS area FROM ({A.ITEMS_SQL}))")
def exclusion_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.with_exclusion(A.items(spark, sf_dir), F.col("body")).select("item_uid", "excluded", "area")


@query(f"SELECT area, count(*) AS n, min(body) AS sample FROM (SELECT body, {_AREA_SQL} AS area FROM ({A.ITEMS_SQL})) GROUP BY 1")
def screen_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.with_exclusion(A.items(spark, sf_dir), F.col("body")).groupBy("area").agg(F.count("*").alias("n"), F.min("body").alias("sample"))


@query("SELECT item_uid, CASE " + " ".join(f"WHEN {_has('body', p)} THEN {_text(s)}" for s, p in L.STAGES) + f" ELSE 'Active litigation' END AS stage FROM ({A.ITEMS_SQL})")
def stage_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.items(spark, sf_dir).select("item_uid", classify.stage(F.col("body"), F.lit("no_event"))["stage"].alias("stage"))


_COURTS = ("S.D.N.Y.", "Delaware Court of Chancery", "Superior Court, Texas", "U.S. District Court, N.D. Ill", "Cook County", "unknown", "New Jersey", "Ninth Circuit")


@query(f"""SELECT s_suppkey, CASE WHEN fed THEN 'Federal' WHEN loc THEN 'State' ELSE 'Unknown' END AS court_group,
  CASE WHEN fed THEN 'Federal' || coalesce(' — ' || st, '') WHEN loc THEN 'State' || coalesce(' — ' || st, '') ELSE coalesce(st || ' (court unclear)', 'Unknown') END AS court_label
  FROM (SELECT s_suppkey, k IN (3, 7) AS fed, k IN (1, 2, 4) AS loc, CASE k WHEN 0 THEN 'New York' WHEN 1 THEN 'Delaware' WHEN 2 THEN 'Texas' WHEN 3 THEN 'Illinois' WHEN 6 THEN 'New Jersey' END AS st FROM (SELECT s_suppkey, s_suppkey % {len(_COURTS)} AS k FROM supplier))""")
def jurisdiction_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    court = F.element_at(F.array(*[F.lit(c) for c in _COURTS]), (F.col("s_suppkey") % len(_COURTS) + 1).cast("int"))
    return A.read(spark, sf_dir, "supplier").withColumn("j", classify.jurisdiction(F.lit(""), court, F.lit(""))).select("s_suppkey", F.col("j.group").alias("court_group"), F.col("j.label").alias("court_label"))


@query(f"SELECT item_uid, strength, observed FROM (SELECT item_uid, strength, published_at AS observed FROM ({_CLASSIFIED_SQL}) WHERE thesis <> 'none' AND ({_AREA_SQL}) = 'none' ORDER BY strength DESC, published_at DESC, item_uid LIMIT {L.CANDIDATES_A_DAY})")
def candidate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's candidates for extraction: in scope, with a signal, strongest first."""
    signalled = classify.with_event(A.items(spark, sf_dir), F.col("body")).where("thesis <> 'none'")
    rows = classify.with_exclusion(signalled, F.col("body")).where("not excluded")
    return rows.select("item_uid", "strength", F.col("published_at").alias("observed")).orderBy(F.desc("strength"), F.desc("observed"), "item_uid").limit(L.CANDIDATES_A_DAY)


# --- Keys, merges, access layer ------------------------------------------------------------------
@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'us v ' || p_name || ' ' || CAST(p_partkey AS VARCHAR) WHEN p_partkey % 4 = 1 THEN '' ELSE p_name || ' ' || CAST(p_partkey AS VARCHAR) || ' v smith' END AS caption_key FROM part")
def caption_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.concat(F.initcap("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))
    caption = F.when(k % 4 == 0, F.concat(F.lit("United States of America and 17 States v. "), name, F.lit(", Inc. (appeal)"))).when(k % 4 == 1, "United States").otherwise(F.concat(F.lit("The "), name, F.lit(" Co., LLC v. Smith & Co.")))
    return cluster.with_caption_key(A.read(spark, sf_dir, "part"), caption, "caption_key").select("p_partkey", "caption_key")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE '26-cv-' || CAST(o_orderkey % 100000 AS VARCHAR) END AS docket_key FROM orders")
def docket_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("No. 1:26-cv-"), number)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("26-CV-"), number, F.lit(" (PAE)"))).otherwise("sealed")
    return cluster.with_docket_key(A.read(spark, sf_dir, "orders"), text, "docket_key").select("o_orderkey", "docket_key")


@query("SELECT doc_id, sha256(source || chr(0) || CAST(doc_id AS VARCHAR)) AS item_uid FROM documents")
def item_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "documents").select("doc_id", T.item_uid(F.col("source"), F.col("doc_id").cast("string")).alias("item_uid"))


@query("SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def unextracted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "documents").select("doc_id").join(A.read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR coalesce(l.quality, 0) < 1")
def refresh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = A.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("known"), "quality")
    rows = A.read(spark, sf_dir, "documents").select("doc_id").join(known, F.col("doc_id") == F.col("known"), "left")
    return rows.where(F.col("known").isNull() | (F.coalesce("quality", F.lit(0)) < 1)).select("doc_id")


@query("SELECT source AS source_id, count(*) AS n, max(doc_id) AS newest FROM documents GROUP BY 1")
def items_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "documents").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("n"), F.max("doc_id").alias("newest"))


_SCREENED_SQL = "SELECT doc_id, CASE doc_id % 10 WHEN 3 THEN 'excluded' ELSE 'no_signal' END AS verdict FROM documents WHERE doc_id % 10 IN (3, 7)"


@query(f"""SELECT (SELECT count(*) FROM documents) AS items, (SELECT count(*) FROM ({_SCREENED_SQL})) AS screened_out, (SELECT count(*) FROM ({_SCREENED_SQL}) WHERE verdict = 'excluded') AS excluded, (SELECT count(*) FROM ({_SCREENED_SQL}) WHERE verdict = 'no_signal') AS no_signal,
  (SELECT count(*) FROM labels) AS extracted, (SELECT count(*) FROM labels WHERE toxic = 1) AS extraction_excluded, (SELECT count(*) FROM labels WHERE quality = 1) AS ranked,
  (SELECT count(*) FROM documents LEFT JOIN labels l USING (doc_id) LEFT JOIN ({_SCREENED_SQL}) s USING (doc_id) WHERE l.doc_id IS NULL AND s.doc_id IS NULL) AS awaiting""")
def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of counts along the funnel, each item seen once."""
    items = A.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_uid"))
    labels = A.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_uid"), (F.col("toxic") == 1).alias("is_excluded"), "quality")
    screened = items.where("item_uid % 10 in (3, 7)").withColumn("verdict", F.when(F.col("item_uid") % 10 == 3, "excluded").otherwise("no_signal"))
    return access.funnel(items, screened, labels, labels.where("quality = 1"))


@query("""SELECT d.docket_id, d.hits, d.last_seen FROM (SELECT CAST(json_extract_string(props, '$.k') AS INT) AS docket_id, count(*) AS hits, max(ts) AS last_seen FROM events WHERE event_type <> 'error' GROUP BY 1) d
  ANTI JOIN (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INT) AS docket_id FROM events WHERE event_type = 'signup' AND value > 150) a ON a.docket_id = d.docket_id""")
def candidate_dockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dockets with activity and no alert yet."""
    rows = A.read(spark, sf_dir, "events").withColumn("docket_id", F.get_json_object("props", "$.k").try_cast("int"))
    alerts = rows.where("event_type = 'signup' and value > 150").select("docket_id").distinct()
    return rows.where("event_type <> 'error'").groupBy("docket_id").agg(F.count("*").alias("hits"), F.max("ts").alias("last_seen")).join(alerts, "docket_id", "left_anti")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value IS NOT NULL AND value < 50) AS processed, count(*) FILTER (WHERE value >= 50) AS pending, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1")
def webhook_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") < 50).alias("processed"), F.count_if(F.col("value") >= 50).alias("pending"), F.count_if(F.col("event_type") == "error").alias("failed"))


@query("SELECT confidence, count(*) AS n FROM (SELECT CASE n_nationkey % 3 WHEN 0 THEN 'not_applicable' WHEN 1 THEN 'low' ELSE CASE WHEN n_nationkey % 2 = 0 THEN 'high' ELSE 'partial' END END AS confidence FROM nation) GROUP BY 1")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    has_rss = F.when(k % 3 == 1, False).when(k % 3 == 2, True)
    return A.read(spark, sf_dir, "nation").groupBy(tasks.coverage_confidence(has_rss, F.when(k % 2 == 0, "all").otherwise("orders")).alias("confidence")).agg(F.count("*").alias("n"))


_AGENT_SQL = "CASE s_suppkey % 5 WHEN 0 THEN 'stretto' WHEN 1 THEN 'kroll' WHEN 2 THEN 'epiq' WHEN 3 THEN 'none_retained' ELSE 'unmapped' END"


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = F.when(k % 5 == 0, "Stretto, Inc.").when(k % 5 == 1, "Kroll Restructuring Administration LLC").when(k % 5 == 2, "EPIQ Corporate Restructuring").when(k % 5 == 3, " ").otherwise(F.concat(F.lit("Agent "), F.col("s_nationkey").cast("string")))
    return A.read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("court"), raw.alias("agent_raw"))


@query(f"SELECT s_suppkey, {_AGENT_SQL} AS vendor_id FROM supplier")
def vendor_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).select("s_suppkey", tasks.vendor(F.col("agent_raw")).alias("vendor_id"))


@query(f"SELECT vendor_id, count(*) AS n FROM (SELECT {_AGENT_SQL} AS vendor_id FROM supplier) GROUP BY 1")
def claims_vendor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).groupBy(tasks.vendor(F.col("agent_raw")).alias("vendor_id")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT 'Agent ' || CAST(s_nationkey AS VARCHAR) AS agent_raw, s_nationkey AS court, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier WHERE s_suppkey % 5 = 4")
def claims_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct unmapped agents and courts with each agent's count, combined before the shuffle."""
    rows = _claims(spark, sf_dir).where(tasks.vendor(F.col("agent_raw")) == "unmapped").groupBy("agent_raw", "court").agg(F.count("*").alias("c"))
    return rows.select("agent_raw", "court", F.sum("c").over(Window.partitionBy("agent_raw")).alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') s USING (o_orderkey)")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return store.insert_ignore(o.where("o_orderstatus = 'F'"), o, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("""SELECT user_id, CASE WHEN n.event_id IS NULL THEN o.event_type ELSE n.event_type END AS event_type, coalesce(n.event_id, o.event_id) AS event_id
  FROM (SELECT user_id, 'old' AS event_type, min(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1) o FULL JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events WHERE event_id % 5 = 1 GROUP BY 1) n USING (user_id)""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users known before with their newest event, or as they were; and new users."""
    e = A.read(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    old = e.where("event_id % 2 = 0").groupBy("user_id").agg(F.lit("old").alias("event_type"), F.min("event_id").alias("event_id"))
    return store.upsert(old, e.where("event_id % 5 = 1"), ["user_id"], "event_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS name, greatest(c_acctbal, 100.0) AS hint FROM customer")
def merge_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.read(spark, sf_dir, "customer")
    old = c.select("c_custkey", F.col("c_mktsegment").alias("name"), F.lit(100.0).alias("hint"))
    new = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("name"), F.col("c_acctbal").alias("hint"))
    return store.merge_non_empty(old, new, ["c_custkey"], ["name"], ["hint"])


@query("SELECT 'documents.source' AS rule, count(*) FILTER (WHERE source IS NULL) AS bad FROM documents UNION ALL SELECT 'documents.n_chars', count(*) FILTER (WHERE n_chars <> length(text)) FROM documents UNION ALL SELECT 'labels.toxic', count(*) FILTER (WHERE toxic NOT IN (0, 1)) FROM labels UNION ALL SELECT 'labels.doc_id', count(*) FROM labels ANTI JOIN documents USING (doc_id)")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = A.read(spark, sf_dir, "documents"), A.read(spark, sf_dir, "labels")
    one = lambda df, rule, bad: df.agg(F.count_if(bad).alias("bad")).select(F.lit(rule).alias("rule"), "bad")
    orphan = n.select("doc_id").join(d.select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("bad")).select(F.lit("labels.doc_id").alias("rule"), "bad")
    return one(d, "documents.source", F.col("source").isNull()).unionByName(one(d, "documents.n_chars", F.col("n_chars") != F.length("text"))).unionByName(one(n, "labels.toxic", ~F.col("toxic").isin(0, 1))).unionByName(orphan)


# --- Health, budgets -----------------------------------------------------------------------------
@query(f"""WITH h AS ({A.HEALTH_SQL}), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY observed_at DESC, run_id DESC) AS k FROM h) WHERE k <= 200),
  p AS (SELECT source_id, observed_at, (epoch(observed_at) - epoch(lag(observed_at) OVER (PARTITION BY source_id ORDER BY observed_at, run_id))) / 3600.0 AS gap FROM r WHERE rows_new > 0 AND source_id IN (SELECT source_id FROM r GROUP BY 1 HAVING count(*) >= 8)),
  s AS (SELECT source_id, count(*) AS productive, median(gap) AS typical, max(gap) AS worst, (epoch(TIMESTAMP '2024-02-01') - epoch(max(observed_at))) / 3600.0 AS since FROM p GROUP BY 1 HAVING count(*) >= 3)
  SELECT source_id, productive, round(typical, 6) AS typical_h, round(worst, 6) AS worst_h, round(since, 6) AS since_h, since > greatest(worst, typical * 2) AS is_stale FROM s""")
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.staleness(A.health(spark, sf_dir), "2024-02-01 00:00:00")


@query(f"SELECT source_id, observed_at, rows_new FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY observed_at DESC, run_id DESC) AS k FROM ({A.HEALTH_SQL})) WHERE k <= 10")
def latest_n_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.latest(A.health(spark, sf_dir), 10).select("source_id", "observed_at", "rows_new")


@query("""SELECT event_id, CASE WHEN m AND NOT b THEN 'HEALTHY' WHEN p = 0 AND e THEN 'HEALTHY' WHEN p = 0 THEN 'BROKEN' ELSE 'HEALTHY' END AS verdict,
  CASE WHEN m AND NOT b THEN 'nothing to parse' WHEN p = 0 AND e THEN 'the server reports no rows' WHEN p = 0 AND m THEN 'no rows in a cached body' WHEN p = 0 THEN 'no rows in a new body' WHEN n = 0 THEN 'parsed ' || p || ', none new' ELSE 'parsed ' || p || ', ' || n || ' new' END AS note
  FROM (SELECT event_id, event_id % 3 AS p, event_id % 2 AS n, event_id % 5 < 2 AS m, event_id % 7 < 4 AS b, event_id % 11 < 3 AS e FROM events)""")
def run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every kind: cached or new, with a body or none, empty as the server says or not."""
    k = F.col("event_id")
    v = health.verdict((k % 3).cast("long"), (k % 2).cast("long"), k % 5 < 2, k % 7 < 4, k % 11 < 3)
    return A.read(spark, sf_dir, "events").withColumn("v", v).select("event_id", "v.verdict", "v.note")


@query("SELECT user_id AS source_id, count(*) FILTER (WHERE event_type = 'error' AND event_id > coalesce(last_ok, -1)) AS consecutive_failures, count(*) AS runs FROM (SELECT *, max(CASE WHEN event_type <> 'error' THEN event_id END) OVER (PARTITION BY user_id) AS last_ok FROM events) GROUP BY 1")
def health_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.trailing_failures(A.read(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.col("event_id").alias("seq"), (F.col("event_type") == "error").alias("failed")))


@query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS asked, least(count(*), 300) AS granted, greatest(0, 300 - count(*)) AS remaining, min(event_id) FILTER (WHERE k >= 240) AS warned_at FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS k FROM events) GROUP BY 1")
def budget_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.budget(A.read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("seq")), 300)


@query("SELECT event_id, count(*) OVER w AS recent, count(*) OVER w > 2 AS locked FROM (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)")
def lockouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.sliding_counts(A.read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("key"), "ts"), 86400, 2).select("event_id", "recent", "locked")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) > 2 AS over_cap FROM events GROUP BY 1")
def hourly_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), (F.count("*") > 2).alias("over_cap"))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.unix_timestamp("ts").alias("at"), (F.col("event_type") == "error").alias("failed"))


_CALLS_SQL = 'SELECT user_id AS key, event_id AS seq, CAST(floor(epoch(ts)) AS DOUBLE) AS "at", event_type = \'error\' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS r FROM events'


@query(f"""WITH RECURSIVE c AS ({_CALLS_SQL}), t AS (SELECT key, seq, "at", r, CAST(2 AS DOUBLE) AS tokens FROM c WHERE r = 1 UNION ALL
  SELECT c.key, c.seq, c."at", c.r, least(CAST(2 AS DOUBLE), t.tokens - CASE WHEN t.tokens >= 1 THEN 1 ELSE 0 END + (c."at" - t."at") * (CAST(1 AS DOUBLE) / 86400)) FROM t JOIN c ON c.key = t.key AND c.r = t.r + 1) SELECT key, seq, "at", tokens >= 1 AS passed FROM t""")
def token_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.token_bucket(_calls(spark, sf_dir), 1 / 86400, 2.0)


@query(f"""WITH RECURSIVE c AS ({_CALLS_SQL}), t AS (SELECT key, seq, "at", failed, r, 'closed' AS state, failed::INT AS bad, CAST(NULL AS DOUBLE) AS opened FROM c WHERE r = 1 UNION ALL
  SELECT key, seq, "at", failed, r, state, CASE WHEN state = 'open' THEN bad WHEN failed THEN bad + 1 ELSE 0 END, CASE WHEN state = 'open' THEN opened WHEN failed AND (state = 'half_open' OR bad + 1 >= 2) THEN "at" END
  FROM (SELECT c.*, t.bad, t.opened, CASE WHEN t.opened IS NULL THEN 'closed' WHEN c."at" - t.opened < 86400 THEN 'open' ELSE 'half_open' END AS state FROM t JOIN c ON c.key = t.key AND c.r = t.r + 1)) SELECT key, seq, "at", failed, state FROM t""")
def breaker_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.breaker(_calls(spark, sf_dir), failures=2, rest=86400.0)


# --- Pages, plans, JSON --------------------------------------------------------------------------
@query("SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, url_decode(replace(coalesce(regexp_extract(url, '^[^#]*?[?&]utm_source=([^&#]*)', 1), ''), '+', ' ')) AS campaign FROM pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "pages").select("page_id", T.url_host(F.col("url")).alias("host"), T.query_value(F.col("url"), "utm_source").alias("campaign"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'Ftc V. Acme ' || (o_orderkey % 10) || 'Nd Co' END AS title FROM orders")
def slug_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.when(F.col("o_orderkey") % 3 == 0, "12345").otherwise(F.concat(F.lit("ftc-v.-ACME-"), (F.col("o_orderkey") % 10).cast("string"), F.lit("nd-co")))
    return A.read(spark, sf_dir, "orders").select("o_orderkey", T.slug_title(F.concat(F.lit("https://h.gov/news/"), slug, F.lit("?x=1"))).alias("title"))


@query("SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') || ':' || q AS task_key FROM (SELECT unnest(generate_series(TIMESTAMP '2001-08-25', TIMESTAMP '2001-09-01', INTERVAL 1 DAY)) AS d), (SELECT unnest(['settlement', 'verdict']) AS q)")
def plan_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.day_query_form(spark, "2001-09-01", 8, ["settlement", "verdict"], anchor=False)


@query("SELECT page_id, CASE WHEN host LIKE '%.example.org' OR host = 'example.org' THEN 'org' WHEN host LIKE '%.example.com' OR host = 'example.com' THEN 'com' ELSE '_default' END AS rate_key FROM (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages)")
def rate_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"example.org": "org", "example.com": "com"}
    return A.read(spark, sf_dir, "pages").select("page_id", tasks.longest_suffix(T.url_host(F.col("url")), keys, "_default").alias("rate_key"))


@query("SELECT page_id, length(html) AS n, (length(html) - length(replace(html, '<li>', ''))) // 4 AS items FROM pages")
def page_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("n"), F.floor((F.length("html") - F.length(F.replace("html", F.lit("<li>"), F.lit("")))) / 4).cast("long").alias("items"))


_READABLE_SQL = "html"
for _tag in ("script", "style", "nav", "header", "footer"):
    _READABLE_SQL = f"regexp_replace({_READABLE_SQL}, '(?is)<{_tag}\\b.*?</{_tag}>', ' ', 'g')"
_READABLE_SQL = f"regexp_replace({_READABLE_SQL}, '(?s)<[^>]+>', ' ', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
    _READABLE_SQL = f"replace({_READABLE_SQL}, '{_entity}', '{_char}')"


@query(f"SELECT page_id, trim(regexp_replace({_READABLE_SQL}, '[\\s\\x0B\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS text FROM pages")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "pages").select("page_id", T.readable(F.col("html")).alias("text"))


@query("SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') || ':' || f || ':' || q AS task_key FROM (SELECT unnest(generate_series(TIMESTAMP '2001-08-30', TIMESTAMP '2001-09-01', INTERVAL 1 DAY)) AS d), (SELECT unnest(['8-K', '10-Q', '10-K']) AS f), (SELECT unnest(['settlement', 'judgment', 'verdict']) AS q) UNION ALL SELECT 'anchor'")
def plan_day_query_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.day_query_form(spark, "2001-09-01", 3, ["settlement", "judgment", "verdict"], ["8-K", "10-Q", "10-K"])


@query("SELECT strftime(d::DATE, '%Y-%m-%d') AS day, 'edgar/daily-index/' || year(d) || '/QTR' || quarter(d) AS path FROM (SELECT unnest(generate_series(TIMESTAMP '2001-08-25', TIMESTAMP '2001-09-05', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6")
def business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.business_days(spark, "2001-09-05", 12).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type || ':' || CAST(json_extract_string(props, '$.k') AS INT) AS natural_key FROM events")
def json_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return A.read(spark, sf_dir, "events").select("event_id", k.alias("k"), F.concat("event_type", F.lit(":"), k.cast("string")).alias("natural_key"))


@query("SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS tf FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS token FROM documents) WHERE token IN ('the', 'der', 'los', 'les', 'license.') GROUP BY 1")
def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of an inverted index, for a few tokens."""
    rows = A.read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.lower("text"), " ")).alias("token")).where(F.col("token").isin("the", "der", "los", "les", "license."))
    return rows.groupBy("token", "doc_id").agg(F.count("*").alias("n")).groupBy("token").agg(F.count("*").alias("docs"), F.sum("n").alias("tf"))


# --- Descriptions, policy, JSON arrays, absorption, streams --------------------------------------
_DESCRIBED_SQL = f"""SELECT item_uid, {_case('event_type', classify.EVENT_PHRASE, 'Something happened')}
  || CASE WHEN ar <> '' THEN ' in ' || CASE WHEN ar LIKE 'a%' THEN 'an ' ELSE 'a ' END || ar || ' matter' ELSE '' END || ' in ' || venue || '.'
  || CASE WHEN damages_usd IS NULL THEN ' No amount stated.' ELSE ' Stated.' END || ' It ' || {_case('deal_thesis', classify.THESIS_PHRASE, '')} || '.' || CASE WHEN is_public THEN ' Defendant is a public company.' ELSE '' END AS sentence
  FROM (SELECT *, {_case('practice_area', classify.AREA_PHRASE, '')} AS ar FROM ({A.EXTRACTIONS_SQL}))"""


@query(_DESCRIBED_SQL)
def describe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.when(F.col("damages_usd").isNotNull(), "#")
    sentence = classify.description(F.col("event_type"), F.col("deal_thesis"), F.col("practice_area"), F.col("venue"), stated, F.col("is_public"))
    return A.extractions(spark, sf_dir).select("item_uid", F.replace(sentence, F.lit(" Stated amount #."), F.lit(" Stated.")).alias("sentence"))


@query("SELECT s_suppkey, CASE WHEN st = 'prohibited' THEN 'prohibited' WHEN st = 'research_only' AND s_suppkey % 2 = 0 THEN 'research only' WHEN st = 'unverified' AND s_suppkey % 3 <> 0 THEN 'unverified' WHEN s_suppkey % 10 = 9 THEN 'review expired' ELSE 'allowed' END AS gate FROM (SELECT s_suppkey, CASE s_nationkey % 4 WHEN 0 THEN 'prohibited' WHEN 1 THEN 'research_only' WHEN 2 THEN 'approved' ELSE 'unverified' END AS st FROM supplier)")
def policy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    status = F.when(n % 4 == 0, "prohibited").when(n % 4 == 1, "research_only").when(n % 4 == 2, "approved")
    why = tasks.allowed(status, F.when(k % 2 == 0, "production").otherwise("research"), k % 3 == 0, k % 10 == 9)
    return A.read(spark, sf_dir, "supplier").select("s_suppkey", F.coalesce(why, F.lit("allowed")).alias("gate"))


@query("SELECT page_id, url LIKE 'http%://%.example.org/%' OR regexp_matches(url, '^https?://[^/]*/en/[0-9]') AS in_scope FROM pages")
def url_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "pages").select("page_id", (F.col("url").like("http%://%.example.org/%") | F.col("url").rlike("^https?://[^/]*/en/[0-9]")).alias("in_scope"))


@query("SELECT o_custkey, count(*) AS n, list_aggregate(list_sort(list(o_orderkey)), 'string_agg', ',') AS affiliates FROM orders GROUP BY 1")
def affiliates_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of a lead with nested affiliates, built, read back and flattened."""
    names = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: F.struct(x.cast("string").alias("name")))
    built = A.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(names.alias("sub"))).alias("j"))  # a customer's orders are few
    read = F.from_json("j", "sub array<struct<name: string>>")["sub"]
    return built.select("o_custkey", F.size(read).cast("long").alias("n"), F.array_join(F.transform(read, lambda x: x["name"]), ",").alias("affiliates"))


@query("SELECT 'cap:' || p_brand || ' ' || p_size || ' v smith' AS short, max('cap:' || p_brand || ' ' || p_size || ' v smith ' || p_name) AS target FROM part GROUP BY p_brand, p_size HAVING count(DISTINCT p_name) = 1")
def absorb_et_al(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-ended captions with one extension."""
    p = A.read(spark, sf_dir, "part")
    short = p.select(F.concat(F.lit("cap:"), "p_brand", F.lit(" "), F.col("p_size").cast("string"), F.lit(" v smith")).alias("cluster_key"), F.lit(True).alias("all_open"))
    long = p.select(F.concat(F.lit("cap:"), "p_brand", F.lit(" "), F.col("p_size").cast("string"), F.lit(" v smith "), "p_name").alias("cluster_key"), F.lit(False).alias("all_open"))
    return cluster.absorptions(short.unionByName(long).distinct())


@query("SELECT DISTINCT event_type, user_id FROM events")
def key_state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "events").select("event_type", "user_id").dropDuplicates(["event_type", "user_id"])


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.read(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), "event_type", "n")
