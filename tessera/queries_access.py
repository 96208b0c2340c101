"""More queries over the driver's tables: the access layer's reads, connectors, expectations, exports, extractor batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import classify, lexicon as L
from .functions import text as T
from .operators import access, extracts, store
from .plans import adapters as A
from .plans import expectations, tasks
from .queries import _CLASSIFIED_SQL, _has, _scored, _text, query
from .sinks import export
from .sources import connectors, robots, spool
from .streaming import ingest


def _values(column: str, values: tuple[str, ...]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN {_text(v)}" for i, v in enumerate(values)) + " END"


def _pick(key, values: tuple[str, ...]):
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(key == i, v).otherwise(out)
    return out


# --- Tables of the access layer, out of the star schema ------------------------------------------
COURTS_SQL = "SELECT 'c' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS court_id, n_name AS full_name, r_name AS jurisdiction, CASE n_nationkey % 3 WHEN 1 THEN 'low' WHEN 2 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'high' ELSE 'partial' END ELSE 'not_applicable' END AS confidence FROM nation JOIN region ON n_regionkey = r_regionkey"
ALERTS_SQL = "SELECT o_orderkey AS docket_id, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, o_orderdate AS created_at FROM orders WHERE o_orderkey % 5 = 0"
WEBHOOKS_SQL = "SELECT CAST(event_id AS VARCHAR) AS idempotency_key, ts AS received_at, CASE WHEN value < 50 THEN ts END AS processed_at, CASE WHEN event_type <> 'error' THEN user_id END AS docket_id FROM events"
RUN_TASKS_SQL = "SELECT 'r' || CAST(l_orderkey % 97 AS VARCHAR) AS run_id, l_returnflag AS source_id, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS task_key, CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'OK' ELSE CASE l_linestatus WHEN 'O' THEN 'PENDING' ELSE 'OK' END END AS status, CAST(l_quantity AS BIGINT) AS rows_new, CASE WHEN l_orderkey % 3 = 0 AND l_returnflag = 'R' THEN 'BROKEN' ELSE 'HEALTHY' END AS verdict, l_linenumber = 7 AS is_partial FROM lineitem"
RUNS_SQL = "SELECT 'run-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS run_id, min(ts) AS started_at, max(ts) AS finished_at, count(*) AS n FROM events GROUP BY 1"
ENROLL_SQL = "SELECT CAST(100000 + c_custkey AS VARCHAR) || '/2024' AS index_number, CASE c_custkey % 4 WHEN 0 THEN 'candidate' WHEN 1 THEN 'enrolled' WHEN 2 THEN 'confirmed' ELSE 'dropped' END AS status, c_acctbal AS score_hint, c_custkey AS added_at FROM customer"
SOURCES_SQL = "SELECT s_name AS source_id, s_name || ' source' AS display_name, CASE WHEN s_nationkey < 10 THEN 'A' ELSE 'B' END AS tier, CASE WHEN s_acctbal < 0 THEN 'BROKEN' WHEN s_suppkey % 5 = 0 THEN 'unknown' ELSE 'HEALTHY' END AS health, CASE WHEN s_acctbal < 0 THEN s_suppkey END AS consecutive_failures FROM supplier"
CLAIMS_SQL = "SELECT sha256('claims_routing' || chr(0) || CAST(o_orderkey AS VARCHAR)) AS item_uid, CASE WHEN o_orderkey % 2 = 0 THEN 'claims_assignment' ELSE 'vendor' END AS record_kind, 'court ' || CAST(o_custkey % 7 AS VARCHAR) AS court, CAST(o_orderkey AS VARCHAR) AS case_number, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_filed FROM orders"


def courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = A.read(spark, sf_dir, "nation"), A.read(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    told = tasks.coverage_confidence(F.when(k % 3 == 1, False).when(k % 3 == 2, True), F.when(k % 2 == 0, "all").otherwise("orders"))
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(F.concat(F.lit("c"), F.lpad(k.cast("string"), 2, "0")).alias("court_id"), F.col("n_name").alias("full_name"), F.col("r_name").alias("jurisdiction"), told.alias("confidence"))


def docket_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0")
    return o.select(F.col("o_orderkey").alias("docket_id"), F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed").alias("status"), F.col("o_orderdate").alias("created_at"))


def webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("idempotency_key"), F.col("ts").alias("received_at"), F.when(F.col("value") < 50, F.col("ts")).alias("processed_at"), F.when(F.col("event_type") != "error", F.col("user_id")).alias("docket_id"), F.col("props").alias("payload_json"))


def run_tasks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = A.read(spark, sf_dir, "lineitem")  # noqa: E741
    flag = F.col("l_returnflag")
    status = F.when(flag == "R", "FAILED").when(flag == "A", "OK").when(F.col("l_linestatus") == "O", "PENDING").otherwise("OK")
    return l.select(F.concat(F.lit("r"), (F.col("l_orderkey") % 97).cast("string")).alias("run_id"), flag.alias("source_id"), F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("task_key"), status.alias("status"), F.col("l_quantity").cast("long").alias("rows_new"), F.when((F.col("l_orderkey") % 3 == 0) & (flag == "R"), "BROKEN").otherwise("HEALTHY").alias("verdict"), (F.col("l_linenumber") == 7).alias("is_partial"))


def sources_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.read(spark, sf_dir, "supplier")
    bad = F.col("s_acctbal") < 0
    return s.select(F.col("s_name").alias("source_id"), F.concat("s_name", F.lit(" source")).alias("display_name"), F.when(F.col("s_nationkey") < 10, "A").otherwise("B").alias("tier"), F.lit("approved").alias("status"), F.lit(0.8).alias("base_confidence"), F.lit(True).alias("enabled"), F.when(bad, "BROKEN").when(F.col("s_suppkey") % 5 == 0, "unknown").otherwise("HEALTHY").alias("health"), F.when(bad, F.col("s_suppkey")).alias("consecutive_failures"))


def enrollment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return A.read(spark, sf_dir, "customer").select(F.concat((k + 100000).cast("string"), F.lit("/2024")).alias("index_number"), _pick(k % 4, ("candidate", "enrolled", "confirmed", "dropped")).alias("status"), F.col("c_acctbal").alias("score_hint"), k.alias("added_at"))


def claim_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    payload = F.to_json(F.struct(F.when(k % 2 == 0, "claims_assignment").otherwise("vendor").alias("record_kind"), F.concat(F.lit("court "), (F.col("o_custkey") % 7).cast("string")).alias("court"), k.cast("string").alias("case_number"), F.when(k % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_filed")))
    return A.read(spark, sf_dir, "orders").select(T.item_uid(F.lit("claims_routing"), k.cast("string")).alias("item_uid"), payload.alias("payload_json"))


# --- Named reads ---------------------------------------------------------------------------------
@query(f"SELECT docket_id, status, created_at FROM ({ALERTS_SQL}) WHERE status = 'active'")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.alerts(docket_alerts(spark, sf_dir), "active")


@query(f"SELECT idempotency_key, received_at, row_number() OVER (ORDER BY received_at, idempotency_key) AS place FROM ({WEBHOOKS_SQL}) WHERE processed_at IS NULL ORDER BY received_at, idempotency_key LIMIT 200")
def unprocessed_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.unprocessed_webhooks(webhooks(spark, sf_dir), 200).select("idempotency_key", "received_at", "place")


@query(f"SELECT *, row_number() OVER (ORDER BY confidence, court_id) AS place FROM ({COURTS_SQL}) WHERE confidence IN ('low', 'partial') ORDER BY confidence, court_id LIMIT 10")
def low_coverage_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.low_coverage_courts(courts(spark, sf_dir), 10)


@query(f"SELECT *, row_number() OVER (ORDER BY CASE confidence WHEN 'low' THEN 0 WHEN 'partial' THEN 1 WHEN 'high' THEN 2 ELSE 3 END, court_id) AS place FROM ({COURTS_SQL})")
def all_court_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.all_court_coverage(courts(spark, sf_dir))


@query("SELECT 'b' || CAST(s_suppkey AS VARCHAR) AS batch_id FROM supplier WHERE s_nationkey % 2 = 0")
def open_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = A.read(spark, sf_dir, "supplier").select(F.concat(F.lit("b"), F.col("s_suppkey").cast("string")).alias("batch_id"), F.when(F.col("s_nationkey") % 2 == 0, "submitted").otherwise("collected").alias("status"))
    return access.open_batches(batches)


@query(f"SELECT left(item_uid, 60) AS custom_id, item_uid FROM ({A.ITEMS_SQL})")
def batch_custom_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.batch_custom_id_map(A.items(spark, sf_dir))


@query(f"SELECT e.item_uid, e.deal_thesis, i.natural_key, i.title, i.published_at FROM ({A.EXTRACTIONS_SQL}) e JOIN ({A.ITEMS_SQL}) i USING (item_uid) WHERE e.is_public")
def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.extractions(spark, sf_dir).select("item_uid", "deal_thesis", (~F.col("is_public")).alias("is_excluded"))
    i = A.items(spark, sf_dir).withColumn("source_url", F.lit(""))
    return access.extractions(e, i).join(i.select("item_uid", "natural_key"), "item_uid").select("item_uid", "deal_thesis", "natural_key", "title", "published_at")


@query(f"SELECT item_uid, published_at, row_number() OVER (ORDER BY published_at DESC, item_uid) AS place FROM ({A.ITEMS_SQL}) WHERE source_id = 'ASIA' ORDER BY published_at DESC, item_uid LIMIT 50")
def recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.recent_items(A.items(spark, sf_dir), 50, "ASIA").select("item_uid", "published_at", "place")


@query(f"SELECT index_number, status, score_hint, added_at, row_number() OVER (ORDER BY CASE status WHEN 'confirmed' THEN 0 WHEN 'enrolled' THEN 1 WHEN 'candidate' THEN 2 ELSE 3 END, score_hint DESC, index_number) AS place FROM ({ENROLL_SQL}) ORDER BY place LIMIT 200")
def enrollments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.enrollments(enrollment_table(spark, sf_dir))


@query(f"SELECT court, case_number, date_filed, row_number() OVER (ORDER BY date_filed DESC NULLS LAST, case_number DESC) AS place FROM ({CLAIMS_SQL}) WHERE record_kind = 'claims_assignment' ORDER BY place LIMIT 500")
def claims_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.claims_assignments(claim_items(spark, sf_dir)).select("court", "case_number", "date_filed", "place")


@query(f"SELECT source_id, display_name, tier, health, consecutive_failures FROM ({SOURCES_SQL})")
def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.source_rows(sources_table(spark, sf_dir)).select("source_id", "display_name", "tier", "health", "consecutive_failures")


@query(f"SELECT source_id, coalesce(consecutive_failures, 0) AS consecutive_failures FROM ({SOURCES_SQL})")
def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.consecutive_failures(sources_table(spark, sf_dir))


@query(f"SELECT * FROM ({RUNS_SQL}) ORDER BY started_at DESC, run_id DESC LIMIT 1")
def last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = A.read(spark, sf_dir, "events").groupBy(F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id")).agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.count("*").alias("n"))
    return access.last_run(runs)


@query(f"SELECT count(*) AS n FROM ({A.ITEMS_SQL}) WHERE source_id = 'EUROPE'")
def count_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.count_items(A.items(spark, sf_dir), "EUROPE")


@query(f"SELECT source_id, task_key, status FROM ({RUN_TASKS_SQL}) WHERE run_id = 'r13' AND status IN ('PENDING', 'RUNNING', 'FAILED')")
def pending_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.pending_tasks(run_tasks_table(spark, sf_dir), "r13").select("source_id", "task_key", "status")


@query(f"SELECT source_id, task_key, status, rows_new FROM ({RUN_TASKS_SQL}) WHERE run_id = 'r13'")
def run_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.run_tasks(run_tasks_table(spark, sf_dir), "r13").select("source_id", "task_key", "status", "rows_new")


@query("SELECT user_id, max(event_id) AS value, list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',') AS seen FROM events WHERE user_id = (SELECT min(user_id) FROM events) GROUP BY 1")
def get_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.read(spark, sf_dir, "events")
    marks = e.groupBy(F.col("user_id").cast("string").alias("source_id"), F.lit("t").alias("task_key")).agg(F.max("event_id").alias("value"), F.to_json(F.collect_set("event_type")).alias("seen_keys"))  # five types at most
    least = str(e.agg(F.min("user_id")).first()[0])
    return access.get_watermark(marks, least, "t").select(F.lit(int(least)).cast("long").alias("user_id"), "value", F.array_join(F.array_sort("seen_keys"), ",").alias("seen"))


@query(f"SELECT run_id, CAST(sum(rows_new) AS BIGINT) AS total_new, count(*) FILTER (WHERE verdict = 'BROKEN') AS failures, count(*) FILTER (WHERE is_partial) AS partials, bool_and(verdict <> 'BROKEN') AS ok FROM ({RUN_TASKS_SQL}) GROUP BY 1")
def run_roll_ups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.roll_up(run_tasks_table(spark, sf_dir))


@query(f"""SELECT (SELECT count(*) FROM ({A.EXTRACTIONS_SQL}) WHERE NOT coalesce(damages_usd > 0, false)) AS imputed, (SELECT round(avg(CASE WHEN coalesce(damages_usd > 0, false) THEN 0.0 ELSE 1.0 END), 6) FROM ({A.EXTRACTIONS_SQL})) AS imputed_share,
  (SELECT count(*) FROM ({COURTS_SQL}) WHERE confidence = 'low') AS dark_venues, (SELECT count(*) FROM ({COURTS_SQL}) WHERE confidence = 'partial') AS partial_venues, (SELECT count(*) FROM ({SOURCES_SQL}) WHERE health NOT IN ('HEALTHY', 'unknown')) AS broken_sources""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.gaps(_scored(spark, sf_dir), courts(spark, sf_dir), sources_table(spark, sf_dir))


# --- Sorts, display, exports ---------------------------------------------------------------------
_STAGE_SQL = "CASE " + " ".join(f"WHEN {_has('body', p)} THEN {_text(s)}" for s, p in L.STAGES) + " ELSE 'Active litigation' END"


@query(f"SELECT stage, count(*) AS n, min(CASE stage {' '.join(f'WHEN {_text(s)} THEN {i}' for i, s in enumerate(access.STAGE_ORDER))} ELSE 20 END) AS stage_rank FROM (SELECT {_STAGE_SQL} AS stage FROM ({A.ITEMS_SQL})) GROUP BY 1")
def stage_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.items(spark, sf_dir).select(classify.stage(F.col("body"), F.lit("no_event"))["stage"].alias("stage")).groupBy("stage").agg(F.count("*").alias("n"))
    return rows.withColumn("stage_rank", access.stage_rank(F.col("stage")))


@query(f"SELECT item_uid, damages_usd, row_number() OVER (ORDER BY coalesce(damages_usd, 0.0) DESC, rank_in_run) AS place FROM (SELECT *, row_number() OVER (ORDER BY item_uid) AS rank_in_run FROM ({A.EXTRACTIONS_SQL})) ORDER BY place LIMIT 50")
def sorted_by_damages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty largest amounts; ties by a rank, here the place of the uid."""
    e = A.extractions(spark, sf_dir).select("item_uid", "damages_usd", F.col("item_uid").alias("rank_in_run"))
    return access.sorted_view(e, "damages", True, 50).select("item_uid", "damages_usd", "place")


@query(f"SELECT item_uid, '{{\"item_uid\":\"' || item_uid || '\",\"deal_thesis\":\"' || deal_thesis || '\",\"collectability_note\":' || coalesce('\"' || collectability_note || '\"', 'null') || '}}' AS value FROM ({A.EXTRACTIONS_SQL})")
def view_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = export.view_json(A.extractions(spark, sf_dir), ["item_uid", "deal_thesis", "collectability_note"])
    return lines.select(F.get_json_object("value", "$.item_uid").alias("item_uid"), "value")


@query(f"""SELECT item_uid AS "URL", case_caption AS "Case", damages_usd AS "Damages (stated)", CASE WHEN k % 3 = 0 THEN 'Firm A; Firm B' WHEN k % 3 = 1 THEN 'not named in document' ELSE 'not captured (pre-v2 extraction)' END AS "Plaintiff counsel", CASE WHEN is_public THEN 'yes' ELSE 'no' END AS "Public defendant",
  strftime(event_date, '%Y-%m-%d') AS "Event date", 22 AS n_columns FROM (SELECT *, length(title) + ascii(item_uid) AS k FROM ({A.EXTRACTIONS_SQL}))""")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.extractions(spark, sf_dir)
    k = F.length("title") + F.ascii("item_uid")
    none = F.lit(None).cast("array<string>")
    rows = e.withColumns({
        "rank_in_run": F.lit(1), "score": F.lit(0.5), "description": F.lit(""), "summary": F.lit(""), "stage": F.lit(""), "cluster_size": F.lit(1), "source_url": F.col("item_uid"), "damages_imputed": ~F.coalesce(F.col("damages_usd") > 0, F.lit(False)),
        "counsel_plaintiff": F.when(k % 3 == 0, F.array(F.lit("Firm A"), F.lit("Firm B"))), "counsel_defendant": none, "defendants": none, "schema_version": F.when(k % 3 == 2, 1).otherwise(2),
    })
    out = export.export(rows)
    return out.select("URL", "Case", "Damages (stated)", "Plaintiff counsel", "Public defendant", "Event date", F.lit(len(out.columns)).alias("n_columns"))


@query(f"SELECT item_uid, hits FROM (SELECT item_uid, count(*) AS hits, count(DISTINCT token) AS n FROM (SELECT item_uid, unnest(regexp_split_to_array(lower(body), '[^a-z0-9]+')) AS token FROM ({A.ITEMS_SQL})) WHERE token IN ('final', 'judgment') GROUP BY 1) WHERE n = 2")
def index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that hold both words, by way of postings."""
    return export.search(export.postings(A.items(spark, sf_dir), F.col("body")), ["Final", "judgment"])


@query("SELECT o_custkey, CASE o_custkey % 4 WHEN 0 THEN 'xml' WHEN 1 THEN 'html' WHEN 2 THEN 'pdf' ELSE 'bin' END AS ext FROM orders")
def artifact_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey") % 4
    kind = _pick(k, ("Application/RSS+xml; charset=utf-8", "text/html", "application/octet-stream"))
    return A.read(spark, sf_dir, "orders").select("o_custkey", expectations.extension(kind, F.when(k == 2, "http://x/Y.PDF").otherwise("http://x/y")).alias("ext"))


@query("SELECT sha256(html) AS sha256, min(octet_length(encode(html))) AS byte_size, min(octet_length(encode(html))) >= 2048 AS compressed, max(length(html)) AS n_chars FROM pages WHERE html IS NOT NULL GROUP BY 1")
def artifact_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by content, packed and unpacked again."""
    pages = A.read(spark, sf_dir, "pages").where("html is not null").select(F.lit("p").alias("source_id"), "url", F.lit("text/html").alias("content_type"), F.encode("html", "UTF-8").alias("content"))
    stored = export.addressed(pages)
    back = export.unpacked(stored).select("sha256", F.length(F.decode("content", "UTF-8")).cast("long").alias("n_chars"))
    return stored.select("sha256", "byte_size", "compressed").join(back, "sha256")


# --- Expectations and connectors over artifacts made of the star schema --------------------------
@query("""SELECT page_id, CASE WHEN k = 1 THEN 'content type text/plain' WHEN n < 300 THEN 'too short: ' || n WHEN n > 20000 THEN 'too long: ' || n WHEN NOT contains(html, '<body') THEN 'no marker <body' WHEN NOT contains(html, '<p') THEN 'no anchor <p' END AS failure
  FROM (SELECT page_id, html, page_id % 5 AS k, octet_length(encode(coalesce(html, ''))) AS n FROM pages)""")
def structural_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"page": expectations.Expectation(("text/html",), 300, 20_000, ("<body",), ("<p",))}
    pages = A.read(spark, sf_dir, "pages").select("page_id", F.lit("page").alias("source_id"), F.encode("html", "UTF-8").alias("content"), F.when(F.col("page_id") % 5 == 1, "text/plain").otherwise("text/html").alias("content_type"))
    return expectations.checked(pages, wanted).select("page_id", "failure")


_LABELS = ("Proposed Final Judgment as to A", "FINAL JUDGMENT", "Competitive Impact Statement", "Consent decree", "Joint Stipulation", "Hold Separate Order", "Complaint", "Press release")
_CLASSES = ("settlement_proposed", "judgment_entered", "settlement_proposed", "settlement_proposed", "settlement_proposed", "settlement_proposed", "case_filed", "other")


@query(f"SELECT 's' || s_suppkey AS path, 'row[0]/doc[' || j || ']' AS locator, 'US v. ' || s_name AS case_title, {_values('(s_suppkey + j) % 8', _LABELS)} AS label, {_values('(s_suppkey + j) % 8', _CLASSES)} AS event_class, DATE '2026-08-14' AS published_on FROM supplier, (SELECT unnest([0, 1]) AS j)")
def scan_case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of cases out of pages of HTML."""
    k = F.col("s_suppkey")
    link = lambda j: F.concat(F.lit(f'<p><a href="/d{j}">'), _pick((k + j) % 8, _LABELS), F.lit("</a></p>"))
    page = F.concat(F.lit('<div class="other">x</div><div class="views-row odd"><h3>US v. '), "s_name", F.lit("</h3><div>August  14, 2026</div>"), link(0), link(1), F.lit('</div><div class="views-row"><a href="y">no case</a></div>'))
    spooled = A.read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), k.cast("string")).alias("path"), F.encode(page, "UTF-8").alias("content"))
    return connectors.case_documents(spooled).drop("href")


@query("SELECT CAST(o_custkey AS VARCHAR) AS path, 'USCOURTS-' || CASE WHEN o_orderkey % 3 = 0 THEN 'nysd' ELSE 'cacd' END || '-1_26-cv-' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS natural_key, CASE WHEN o_orderkey % 3 = 0 THEN 'nysd' ELSE 'cacd' END AS court, '26-cv-' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS case_number FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 1")
def scan_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Civil packages of two courts out of a third, and a kind that is skipped."""
    return connectors.packages(_package_pages(spark, sf_dir), ("nysd", "cacd"))[0].select("path", "natural_key", "court", "case_number")


def _package_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    name = F.concat(F.lit("USCOURTS-"), F.when(k % 3 == 0, "nysd").when(k % 3 == 2, "cacd").otherwise("txsd"), F.lit("-1_26-"), F.when(k % 2 == 0, "cv").otherwise("cr"), F.lit("-"), F.lpad((k % 100000).cast("string"), 5, "0"))
    pages = A.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(name.alias("packageId"))).alias("packages"))  # a customer's orders are few
    return pages.select(F.col("o_custkey").cast("string").alias("path"), F.encode(F.to_json(F.struct("packages")), "UTF-8").alias("content"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS path, count(*) AS given, count(*) FILTER (WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 1) AS kept, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS skipped_kind, count(*) FILTER (WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 1) AS skipped_court FROM orders GROUP BY 1")
def scan_package_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connectors.packages(_package_pages(spark, sf_dir), ("nysd", "cacd"))[1]


@query("SELECT 'sec' AS source_id, 'http://f/' || c_custkey AS url, CASE WHEN c_custkey % 2 = 0 THEN 'LR-' || c_custkey ELSE 'g' || c_custkey END AS natural_key, c_name AS title FROM customer WHERE c_custkey % 3 <> 0")
def scan_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of configured feeds: creator as key, else guid; feeds without a spec are left alone."""
    k = F.col("c_custkey")
    entry = F.concat(F.lit('<rss xmlns:dc="d"><channel><item><title>'), "c_name", F.lit("</title><link>\nhttp://x \n</link><dc:creator>"), F.when(k % 2 == 0, F.concat(F.lit("LR-"), k.cast("string"), F.lit(" "))).otherwise(""), F.lit('</dc:creator><guid isPermaLink="false">g'), k.cast("string"), F.lit("</guid></item></channel></rss>"))
    c = A.read(spark, sf_dir, "customer")
    url = F.concat(F.lit("http://f/"), k.cast("string")).alias("url")
    specs = c.where("c_custkey % 3 <> 0").select(F.lit("sec").alias("source_id"), url, F.lit("creator").alias("key_field"))
    return connectors.configured_feeds(c.select(url, F.concat(F.lit("p"), k.cast("string")).alias("path"), F.encode(entry, "UTF-8").alias("content")), specs).select("source_id", "url", "natural_key", "title")


@query("SELECT coalesce(st, '??') AS state, coalesce(st, '??') || ':' || n_name AS natural_key, '[' || coalesce(st, '??') || '] ' || n_name AS title FROM (SELECT n_name, CASE n_nationkey % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' END AS st, n_nationkey % 4 AS k FROM nation) WHERE k <> 2")
def scan_state_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = spark.createDataFrame([("u0", "NY", "verified"), ("u1", "CA", "verified"), ("u2", "TX", "broken")], "url string, state string, status string")
    entries = A.read(spark, sf_dir, "nation").select(F.concat(F.lit("u"), (F.col("n_nationkey") % 4).cast("string")).alias("url"), F.col("n_name").alias("natural_key"), F.col("n_name").alias("title"))
    return connectors.namespaced_feeds(entries, feeds).select("state", "natural_key", "title")


@query("SELECT CAST(o_orderkey AS VARCHAR) || ':f.htm' AS natural_key, o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 AS relevant, o_custkey AS slice_total, o_custkey % 2 = 0 AS saturated FROM orders")
def scan_search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    hit = F.struct(F.concat(k.cast("string"), F.lit(":f.htm")).alias("_id"), F.struct(F.when(k % 2 == 0, "10-Q").otherwise("8-K").alias("form"), F.array(F.when(k % 3 == 0, "8.01").otherwise("5.02")).alias("items")).alias("_source"))
    pages = A.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(hit).alias("hits")).select("o_custkey", F.struct(F.col("o_custkey").alias("value"), F.when(F.col("o_custkey") % 2 == 0, "gte").otherwise("eq").alias("relation")).alias("total"), "hits")
    spooled = pages.select(F.col("o_custkey").cast("string").alias("path"), F.encode(F.to_json(F.struct(F.struct("total", "hits").alias("hits"))), "UTF-8").alias("content"))
    return spool.search_hits(spooled).select("natural_key", "relevant", "slice_total", "saturated")


@query("SELECT 'recap-doc:' || o_orderkey AS natural_key, o_custkey AS docket_id, count(*) OVER (PARTITION BY o_custkey) < 5 AS truncated FROM orders")
def scan_docket_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("docket_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("entry_date_filed"))
    pages = A.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(entry).alias("results"), F.greatest(F.count("*"), F.lit(5)).alias("count"))
    spooled = pages.select(F.col("o_custkey").cast("string").alias("path"), F.encode(F.to_json(F.struct("count", "results")), "UTF-8").alias("content"))
    return spool.docket_entries(spooled).select("natural_key", "docket_id", "truncated")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS path, CASE WHEN o_orderkey % 2 = 0 THEN '8-K' ELSE 'S-1' END AS form, 'ACME ' || o_orderkey AS company, o_orderkey % 2 = 0 AS of_interest, CAST(o_orderdate AS DATE) AS date_filed FROM orders")
def scan_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit("Form Type   Company\n---\n"), F.when(F.col("o_orderkey") % 2 == 0, "8-K").otherwise("S-1"), F.lit("      ACME "), k, F.lit("     77   "), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("   edgar/data/77/x.txt\n"))
    spooled = A.read(spark, sf_dir, "orders").select(k.alias("path"), F.encode(line, "UTF-8").alias("content"))
    return spool.index_lines(spooled).select("path", "form", "company", "of_interest", "date_filed")


@query("SELECT lpad(CAST(s_suppkey % 90 + 10 AS VARCHAR), 2, '0') || '-10001' AS case_number, s_name AS debtor, 'Kroll' AS agent_raw, 'kroll' AS vendor_id FROM supplier")
def scan_assignment_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.concat(F.lpad((F.col("s_suppkey") % 90 + 10).cast("string"), 2, "0"), F.lit("-10001-ABC"))
    page = F.concat(F.lit("<table><tr><th>Case Number and Judge Initials</th><th>Case Title</th><th>Agent</th><th>Filed</th></tr><tr><td>"), number, F.lit("</td><td>"), "s_name", F.lit("</td><td><a href='k'>Kroll</a></td><td>1/2/2026</td></tr></table>"))
    rows = spool.assignment_tables(A.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("path"), F.encode(page, "UTF-8").alias("content")))
    return rows.select("case_number", "debtor", "agent_raw", tasks.vendor(F.col("agent_raw")).alias("vendor_id"))


@query("SELECT CAST(100000 + c_custkey AS VARCHAR) || '/2025' AS index_number, c_name AS caption, CASE WHEN c_custkey % 2 = 0 THEN 'decision' ELSE 'appearance' END AS event_kind FROM customer WHERE c_custkey % 3 <> 0")
def scan_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    mail = F.concat(F.lit("From: a@"), F.when(k % 3 == 0, "evil.com").otherwise("alerts.nycourts.gov"), F.lit("\nSubject: Alert\nMessage-ID: <m"), k.cast("string"), F.lit(">\n\nIndex No.: "), (k + 100000).cast("string"), F.lit(" / 2025\nCaption - "), "c_name", F.lit("\nNotification Type: "), F.when(k % 2 == 0, "Decision").otherwise("Appearance"), F.lit("\n"))
    rows = spool.alerts(A.read(spark, sf_dir, "customer").select(k.cast("string").alias("path"), F.encode(mail, "UTF-8").alias("content")), ("nycourts.gov", "courts.state.ny.us"))
    return rows.select("index_number", F.col("fields")["caption"].alias("caption"), "event_kind")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_suppkey % 3 = 0 THEN 'https://old/' ELSE 'https://new/' END || CASE WHEN s_suppkey % 4 = 0 THEN 'v' || s_suppkey ELSE s_name END END AS url FROM supplier")
def synthetic_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    url = connectors.case_url((k % 2 == 0).cast("int"), (k % 3 == 0).cast("int"), F.when(k % 4 == 0, F.concat(F.lit("v"), k.cast("string"))).otherwise(" "), F.col("s_name"), "https://new", "https://old")
    return A.read(spark, sf_dir, "supplier").select("s_suppkey", url.alias("url"))


@query("SELECT page_id, nullif(regexp_extract(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*[\"'']([^\"'']*/[^\"'']*)[\"'']', 1), '') AS href, html[1:5] = '%PDF-' AS is_pdf FROM pages")
def landing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read(spark, sf_dir, "pages").select("page_id", connectors.linked_document(F.col("html"), "/").alias("href"), connectors.is_pdf(F.encode("html", "UTF-8")).alias("is_pdf"))


# --- Extractor batches, screens, queues ----------------------------------------------------------
@query(f"SELECT coalesce(i.item_uid, left(r.uid, 60)) AS item_uid, CASE WHEN r.k % 5 = 0 THEN 'unparsable payload' END AS error FROM (SELECT item_uid AS uid, CAST(natural_key AS BIGINT) AS k FROM ({A.ITEMS_SQL})) r LEFT JOIN ({A.ITEMS_SQL}) i ON i.item_uid = r.uid AND CAST(i.natural_key AS BIGINT) % 7 <> 0")
def batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results matched by the first 60 characters of the uid; a seventh have no item."""
    items = A.items(spark, sf_dir)
    lines = items.select(F.to_json(F.struct(access.custom_id(F.col("item_uid")).alias("custom_id"), F.when(F.col("natural_key").cast("long") % 5 == 0, "no json").otherwise('{"a":1}').alias("text"))).alias("value"))
    return extracts.results(lines, items.where("cast(natural_key as bigint) % 7 <> 0")).select("item_uid", "error")


@query(f"SELECT left(item_uid, 60) AS custom_id, 'Source: ' || source_id || chr(10) || 'URL: ' || chr(10) || 'Title: ' || title || chr(10) || 'Signal: ' || thesis || chr(10) || 'Practice areas: antitrust' || chr(10) || chr(10) || body AS prompt FROM ({_CLASSIFIED_SQL}) WHERE thesis <> 'none'")
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.with_event(A.items(spark, sf_dir), F.col("body")).where("thesis <> 'none'").withColumns({"source_url": F.lit(None).cast("string"), "hints": F.array(F.lit("antitrust"))})
    lines = extracts.requests(extracts.prompt(rows, "system"), "model", 1000)
    return lines.select(F.get_json_object("value", "$.custom_id").alias("custom_id"), F.get_json_object("value", "$.params.messages[0].content").alias("prompt"))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.quality, 0) < 1")
def extraction_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = A.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_uid"), F.col("quality").alias("schema_version"))
    return extracts.to_refresh(A.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_uid")), known, 1).select(F.col("item_uid").alias("doc_id"))


@query(f"SELECT item_uid, area <> 'none' AS late_excluded, area AS late_area FROM (SELECT item_uid, CASE WHEN {_has('body', L.IP)} THEN 'intellectual_property' WHEN {_has('body', L.INTL_ARB)} THEN 'international_arbitration' WHEN {_has('body', L.CONSUMER)} THEN 'consumer' WHEN {_has('body', L.FORFEITURE)} THEN 'forfeiture' WHEN {_has('body', L.CRIMINAL)} AND NOT {_has('body', L.CRIMINAL_CARVEOUT)} THEN 'criminal' ELSE 'none' END AS area FROM ({A.ITEMS_SQL}))")
def late_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.items(spark, sf_dir).select("item_uid", F.lit("").alias("case_caption"), F.col("body").alias("summary"), F.lit(None).cast("string").alias("posture"))
    return extracts.late_screen(rows).select("item_uid", "late_excluded", "late_area")


@query("""SELECT key, score_hint, row_number() OVER (ORDER BY score_hint DESC, key) AS place FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN CAST(100000 + c_custkey AS VARCHAR) || '/2024' ELSE c_name END AS key, c_acctbal + CASE WHEN c_custkey % 2 = 0 THEN 0.05 ELSE 0.0 END AS score_hint FROM customer WHERE c_custkey % 3 = 0) ORDER BY place LIMIT 25""")
def enrollment_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = A.read(spark, sf_dir, "customer").select(
        k.cast("string").alias("item_uid"), F.col("c_name").alias("case_caption"), F.lit("t").alias("title"), F.when(k % 3 == 0, "Supreme Court, New York County").otherwise("S.D.N.Y.").alias("court"), F.lit("").alias("venue"),
        F.lit(None).cast("string").alias("jurisdiction"), F.when(k % 2 == 0, F.concat(F.lit("Index No. "), (k + 100000).cast("string"), F.lit("/2024"))).otherwise("none").alias("summary"), F.col("c_acctbal").alias("score"),
    )
    return extracts.worklist(rows).select("key", "score_hint", "place")


@query("""SELECT index_number, CASE WHEN dropped THEN 'dropped' WHEN n > 0 THEN 'confirmed' WHEN enrolled IS NOT NULL AND enrolled >= added THEN 'enrolled' ELSE 'candidate' END AS status, n AS alert_count FROM (
  SELECT user_id AS index_number, min(event_id) FILTER (WHERE event_type = 'view') AS added, min(event_id) FILTER (WHERE event_type = 'click') AS enrolled, count(*) FILTER (WHERE event_type = 'purchase') AS n, bool_or(event_type = 'error') AS dropped FROM events GROUP BY 1) WHERE added IS NOT NULL OR n > 0""")
def enrollment_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    events = A.read(spark, sf_dir, "events").select(F.col("user_id").alias("index_number"), F.col("event_id").alias("at"), F.when(kind == "view", "candidate").when(kind == "click", "enroll").when(kind == "purchase", "alert").when(kind == "error", "drop").alias("kind"))
    return store.enrollments(events).select("index_number", "status", "alert_count")


@query("SELECT CAST(event_id AS VARCHAR) AS idempotency_key, CASE WHEN event_type = 'error' THEN 'no docket id in the payload' WHEN user_id % 2 = 1 THEN 'docket is not subscribed' END AS process_error FROM events WHERE value >= 50 OR value IS NULL")
def webhook_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = webhooks(spark, sf_dir)
    watched = queue.where("docket_id % 2 = 0").select("docket_id").distinct()
    return ingest.drain(queue, watched)[1]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'late' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders")
def marked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    delta = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("late").alias("o_orderstatus"))
    return store.mark(o, delta, ["o_orderkey"], ["o_orderstatus"])


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-30 00:00:00'")
def look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.look_back(A.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("published_at")), 3, "2001-08-02").select("o_orderkey")


@query("""SELECT s_name AS path, nullif(concat_ws('; ', CASE WHEN s_suppkey % 2 = 0 THEN 'Content-Signal: ai-train=no' END, CASE WHEN s_suppkey % 3 = 0 THEN 'blocks AI crawlers: ' || CASE WHEN s_suppkey % 5 = 0 THEN 'ccbot' ELSE 'ccbot, gptbot' END END), '') AS ai_signal FROM supplier""")
def robots_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    text = F.concat(
        F.lit("User-agent: *\nDisallow: /x # all\nCrawl-delay: 3\n"), F.when(k % 2 == 0, "Content-Signal: ai-train=no\n").otherwise(""),
        F.when(k % 5 != 0, "User-Agent: GPTBot\n").otherwise(""), F.lit("user-agent: CCBot\nAllow: /y\n"), F.when(k % 3 == 0, "Disallow: /\n").otherwise("Disallow: /z\n"), F.lit("Sitemap: http://s\nUser-agent: ClaudeBot\n"),
    )
    return robots.ai_signals(A.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("path"), text.alias("text")))


@query("SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS damages_usd, 1 AS schema_version, c_mktsegment FROM customer")
def conformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older table under a newer schema."""
    newer = spark.createDataFrame([], "c_custkey long, c_name string, damages_usd double, schema_version int").schema
    return store.conformed(A.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), newer, {"schema_version": 1})
