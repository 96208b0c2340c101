"""Classifiers, keys, score, health, store, parsers and streams on small pinned cases."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import classify
from tessera.functions import text as T
from tessera.operators import cluster, health, scoring, store
from tessera.plans import tasks
from tessera.sources import spool
from tessera.streaming import ingest


def values(spark, column, texts, **more):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r["v"] for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def rows_of(spark, made, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return made(df).orderBy("i").collect()


def test_events_are_told_by_the_first_rule(spark):
    texts = ["Proposed Final Judgment; Sherman Act", "final judgment and notice of appeal", "Proposed jury verdict form", "jury returned", "price-fixing settlement agreement", "jury verdict", "", None, "fairness hearing"]
    got = [(v["thesis"], v["event_class"], v["strength"]) for v in rows_of(spark, lambda df: classify.with_event(df, F.col("x")), texts)]
    assert got == [("antitrust_followon", "settlement_proposed", 0.85), ("judgment_monetization", "appeal", 0.95), ("none", "other", 0.0), ("judgment_monetization", "verdict", 0.9), ("antitrust_followon", "settlement_reached", 0.85), ("judgment_monetization", "verdict", 0.9), ("none", "other", 0.0), ("none", "other", 0.0), ("post_settlement", "settlement_approved", 0.8)]


def test_exclusions_and_their_carve_out(spark):
    texts = ["patent infringement", "patently unfair", "United States v. Approximately 225,364 USDT", "forfeiture of a deposit", "indictment for bid-rigging", "USA as to John", "icsid and tcpa", None]
    got = rows_of(spark, lambda df: classify.with_exclusion(df, F.col("x"), reasons=True), texts)
    assert [(v["excluded"], v["area"]) for v in got] == [(True, "intellectual_property"), (False, "none"), (True, "forfeiture"), (False, "none"), (False, "none"), (True, "criminal"), (True, "international_arbitration"), (False, "none")]
    assert got[4]["matched"] == ["indictment"] and "carve-out" in got[4]["reason"]
    lines = rows_of(spark, lambda df: classify.with_exclusion(df, F.col("x"), reasons=True).withColumn("line", classify.audit_line(F.col("excluded"), F.col("area"), F.col("matched"))), texts[:2])
    assert [r["line"] for r in lines] == ["excluded[intellectual_property] on patent infringement", "kept"]


def test_caption_and_docket_keys(spark):
    captions = ["United States of America and 17 States v. Apple Inc. (appeal)", "U.S. v. Apple", "Smith & Co. v. The Jones Corp.", "In re", "USA", None, "A v B"]
    keys = [r["k"] for r in rows_of(spark, lambda df: cluster.with_caption_key(df, F.col("x"), "k"), captions)]
    assert keys == ["us v apple", "u s v apple", "smith v jones", "", "", "", ""]
    dockets = ["1:26-cv-01234-ABC", "26-CV-1234", "none", None, "26-00012"]
    assert [r["k"] for r in rows_of(spark, lambda df: cluster.with_docket_key(df, F.col("x"), "k"), dockets)] == ["26-cv-1234", "26-cv-1234", "", "", "26--12"]
    both = spark.createDataFrame([(1, "A v B", "26-cv-00005", "u1"), (2, "Smith v. Jones Widgets", "26-cv-00005", "u2"), (3, None, None, "u3")], "i int, case_caption string, docket_number string, item_uid string")
    assert [r["k"] for r in cluster.with_cluster_key(both, "k").orderBy("i").collect()] == ["dkt:26-cv-5", "cap:smith v jones widgets", "uid:u3"]


def test_ranks_are_whole_whatever_columns_are_kept(spark):
    n = 40_000  # more rows than the bounds' sample
    rows = spark.range(n).select(F.concat(F.lit("u"), F.col("id")).alias("item_uid"), F.when(F.col("id") % 7 == 0, 0.5).when(F.col("id") % 1001 != 0, F.round(F.rand(3), 3)).alias("score"), (F.col("id") % 5 != 0).alias("is_primary"), *[F.concat(F.lit("x"), F.col("id") * i).alias(f"c{i}") for i in range(9)])
    got = cluster.ranked(rows).collect()
    heads = sorted((r for r in got if r["is_primary"]), key=lambda r: (r["score"] is None, -(r["score"] or 0), r["item_uid"]))
    assert len(got) == n and [r["rank_in_run"] for r in heads] == list(range(1, len(heads) + 1))
    assert all(r["rank_in_run"] is None for r in got if not r["is_primary"]) and cluster.ranked(rows.limit(0)).count() == 0


def test_absorption_guards(spark):
    rows = [("cap:us v apple", True), ("cap:us v apple google", False), ("cap:us v applebees", False), ("cap:a v b", True), ("cap:a v b c", False), ("cap:a v b d", False), ("cap:x v y", False), ("cap:x v y z", False), ("cap:p v q", True), ("cap:p v q r", True), ("cap:p v q r s", False)]
    got = {(r["short"], r["target"]) for r in cluster.absorptions(spark.createDataFrame(rows, "cluster_key string, all_open boolean")).collect()}
    assert got == {("cap:us v apple", "cap:us v apple google"), ("cap:p v q r", "cap:p v q r s")}


def test_score_parts(spark):
    amounts = spark.createDataFrame([(None,), (5e4,), (1e7,), (2e9,)], "a double")
    assert [r[0] for r in amounts.select(scoring.damages_norm(F.col("a"))).collect()] == [None, 0.0, 0.5, 1.0]
    assert [r[0] for r in amounts.select(scoring.size_band(F.col("a"), F.lit(False))).collect()] == ["Not stated", "Under $10M", "$10M – $50M", "$1B and up"]
    notes = spark.createDataFrame([(True, "Chapter 7 liquidation"), (False, "bond and bankrupt"), (None, None)], "p boolean, n string")
    assert [r[0] for r in notes.select(scoring.collectability(F.col("p"), F.col("n"))).collect()] == [0.25, 0.8, 0.5]
    assert [tuple(v) for v in values(spark, lambda x: F.struct(scoring.venue_match(x)["quality"], scoring.venue_match(x)["needle"]), ["Court of Chancery, Delaware", "nowhere"])] == [(1.0, "delaware"), (0.5, "default")]


def test_stage_and_jurisdiction(spark):
    posture = ["Notice of appeal after final approval", "trial set for May", "  "]
    assert [v["stage"] for v in values(spark, lambda x: classify.stage(x, F.lit("case_filed")), posture)] == ["On appeal", "Trial", "Pleadings"]
    courts = ["Southern District of New York, United States District Court", "Superior Court of Delaware", "S.D. Tex.", ""]
    assert [v["label"] for v in values(spark, lambda x: classify.jurisdiction(F.lit(""), F.lit(""), x), courts)] == ["Federal — New York", "State — Delaware", "Texas (court unclear)", "Unknown"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(max_size=20), min_size=1, max_size=5))
def test_normal_names_are_stable(spark, texts):
    once = values(spark, T.normal_name, texts)
    assert values(spark, T.normal_name, once) == once


def test_verdicts_and_machines(spark):
    runs = spark.createDataFrame([(0, 0, True, False, False), (0, 0, False, True, True), (0, 0, True, True, False), (0, 0, False, True, False), (5, 0, False, True, False), (5, 2, False, True, False)], "p int, n int, m boolean, b boolean, e boolean")
    assert [r[0] for r in runs.select(health.verdict(F.col("p"), F.col("n"), F.col("m"), F.col("b"), F.col("e"))["verdict"]).collect()] == ["HEALTHY", "HEALTHY", "BROKEN", "BROKEN", "HEALTHY", "HEALTHY"]
    calls = spark.createDataFrame([(1, i, at, bad) for i, (at, bad) in enumerate([(0.0, True), (1.0, True), (2.0, False), (12.0, True), (13.0, False), (23.0, False), (24.0, False)])], "key long, seq long, at double, failed boolean")
    assert [r["state"] for r in health.breaker(calls, 2, 10.0).orderBy("seq").collect()] == ["closed", "closed", "open", "half_open", "open", "half_open", "closed"]
    asked = spark.createDataFrame([(1, i, t) for i, t in enumerate([0.0, 0.0, 0.0, 1.0, 1.5])], "key long, seq long, at double")
    assert [r["passed"] for r in health.token_bucket(asked, 1.0, 2.0).orderBy("seq").collect()] == [True, True, False, True, False]


def test_plans_and_lookups(spark):
    agents = ["Kurtzman Carson Consultants", "", None, "Someone", "STRETTO, Inc.", "Omni Management Group", "Logan & Company, Inc.", "Garden City Group", "CPT Group", "Prime Clerk (now Kroll Restructuring)", "Donlin, Recano & Co."]
    assert values(spark, tasks.vendor, agents) == ["verita", "none_retained", "none_retained", "unmapped", "stretto", "omni", "logan", "gcg", "cpt", "kroll", "angeion"]
    assert tasks.business_days(spark, "2026-08-16", 7).count() == 5
    assert values(spark, lambda x: tasks.longest_suffix(x, {"a.b": "1", "x.a.b": "2"}, "d"), ["x.a.b", "y.x.a.b", "za.b", "c.a.b"]) == ["2", "2", "d", "1"]


def test_store_commits_all_or_nothing(spark, tmp_path):
    s = store.VersionedStore(spark, f"file://{tmp_path}/s")
    assert s.read("item") is None
    s.commit({"item": spark.range(3), "watermark": spark.range(1)})
    with pytest.raises(Exception):  # noqa: B017
        s.commit({"item": spark.range(9), "watermark": spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))})
    assert s.read("item").count() == 3
    s.commit({"item": spark.range(5)})
    assert (s.read("item").count(), s.read("watermark").count()) == (5, 1)
    s.commit(append={"item": spark.range(5, 7)})
    assert s.read("item").count() == 7 and len(s.manifest()["item"]) == 2
    other = store.VersionedStore(spark, s.root)
    other._commits = lambda: s._commits()[:-1]  # a writer that began before the last commit
    with pytest.raises(RuntimeError):
        other.commit({"item": spark.range(1)})
    assert s.read("item").count() == 7
    s.compact("item")
    gone = s.vacuum(1)
    assert len(gone) == 6 and s.read("item").count() == 7 and s.read("watermark").count() == 1
    with open(f"{tmp_path}/s/_commits/000000009.json", "w") as torn:
        torn.write('{"item": [')
    assert s.read("item").count() == 7 and s.commit({"item": spark.range(2)}) == 10 and s.read("item").count() == 2


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "k int, t string, n int")
    new = spark.createDataFrame([(1, "", 3), (2, "c", 9), (3, "d", None)], "k int, t string, n int")
    assert sorted(map(tuple, store.merge_non_empty(old, new, ["k"], ["t"], ["n"]).collect())) == [(1, "a", 5), (2, "c", 9), (3, "d", None)]
    assert store.insert_ignore(old, new, ["k"]).count() == 1
    keys = spark.createDataFrame([(["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert keys.select(store.merged_keys(F.col("a"), F.col("b"), 2)).first()[0] == ["b", "c"]


def blobs(spark, *contents):
    return spark.createDataFrame([(f"p{i}", bytearray(c if isinstance(c, bytes) else c.encode())) for i, c in enumerate(contents)], "path string, content binary")


def test_feeds(spark):
    rss = '<rss xmlns:dc="d"><channel><item><title>T</title><link>\nhttp://x/1 \n</link><dc:creator>LR-1 </dc:creator><pubDate>Fri, 14 Aug 2026 10:00:00 -0400</pubDate><guid isPermaLink="false">g</guid></item><item><title> </title></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>i</id><title>A</title><link rel="self" href="s"/><link href="http://y"/><content>c</content><updated>2026-08-14T00:00:00Z</updated></entry></feed>'
    got = spool.feeds(blobs(spark, rss, atom, "<html>", b""), "creator").orderBy("path").collect()
    assert [(r["natural_key"], r["link"], r["description"]) for r in got] == [("LR-1", "http://x/1", None), ("i", "http://y", "c")]
    assert got[0]["published_at"].isoformat() == "2026-08-14T14:00:00"


def test_pages_of_json(spark):
    hits = {"hits": {"total": {"value": 10000, "relation": "gte"}, "hits": [{"_id": "a:f.htm", "_source": {"form": "8-K", "items": ["5.02"]}}, {"_id": "b:g.htm", "_source": {"form": "8-K", "items": ["8.01"]}}, {"_source": {}}]}}
    assert [(r["natural_key"], r["relevant"], r["saturated"]) for r in spool.search_hits(blobs(spark, json.dumps(hits), "no json")).orderBy("place").collect()] == [("a:f.htm", False, True), ("b:g.htm", True, True)]
    cases = {"data": [{"CASE_NO": "26-1", "CASE_ID": "", "sub_debtor": [{"DEBTOR_NAME": " X "}, {"DEBTOR_NAME": ""}]}, {"CASE_ID": "7"}]}
    assert [(r["natural_key"], r["affiliates"]) for r in spool.case_list(blobs(spark, json.dumps(cases))).orderBy("place").collect()] == [("26-1", ["X"]), ("7", [])]
    entries = {"count": 5, "results": [{"id": 3, "docket_id": 9, "entry_date_filed": "2026-08-14"}]}
    assert [(r["natural_key"], r["truncated"]) for r in spool.docket_entries(blobs(spark, json.dumps(entries))).collect()] == [("recap-doc:3", True)]
    assert tuple(values(spark, spool.package_parts, ["USCOURTS-nysd-1_26-cv-01234"])[0]) == ("nysd", "cv", "26-cv-01234")


def test_lines_tables_and_mail(spark):
    index = "Form Type   Company\n---\n8-K         ACME CORP        1234   20260814   edgar/data/1234/x.txt\nS-1   Other Inc   99   20260814   edgar/data/99/y.txt\n"
    assert [(r["form"], r["company"], r["of_interest"]) for r in spool.index_lines(blobs(spark, index)).orderBy("place").collect()] == [("8-K", "ACME CORP", True), ("S-1", "Other Inc", False)]
    page = "<table><tr><th>Case No.</th><th>Debtor</th><th>Claims Agent</th><th>Date Filed</th></tr><tr><td>26-10001 (ABC)</td><td>Foo</td><td><a href='http://k'>Kroll</a></td><td>1/2/2026</td></tr><tr><td>none</td></tr></table><table><tr><td>x</td></tr></table>"
    assert [(r["case_number"], r["debtor"], r["agent_raw"], r["agent_url"]) for r in spool.assignment_tables(blobs(spark, page)).collect()] == [("26-10001", "Foo", "Kroll", "http://k")]
    mail = "From: a@alerts.court.gov\nSubject: Decision 654321/2025\nMessage-ID: <m1>\n\nIndex Number: 123456/2025\nCourt: Supreme\n"
    other = mail.replace("court.gov", "court.gov.evil.com")
    got = spool.alerts(blobs(spark, mail, other, b""), ("court.gov",)).collect()
    assert [(r["index_number"], r["fields"]["court"], r["natural_key"], r["event_kind"]) for r in got] == [("123456/2025", "Supreme", "123456/2025:<m1>", "decision")]
    assert spool.alerts(blobs(spark, mail, other), ("court.gov",), require_trusted=False).count() == 2
    assert values(spark, spool.index_number, ["123/2025", "see 1234567 / 2025.", "Index No: 65/2024 99/2024", "12345678/2025", None]) == ["123/2025", "1234567/2025", None, None, None]
    fields = values(spark, spool.labelled, ["Caption - Foo v. Bar\nStatus: open\nStatus: closed\nOther: x\n Judge : Hon. A"])[0]
    assert fields == {"caption": "Foo v. Bar", "status": "closed", "judge": "Hon. A"}
    headers = "<table><tr><th>Case</th><th>Case Title</th><th>Agent</th><th>Filed</th></tr><tr><td>26-10002-XYZ</td><td>Bar</td><td>Epiq</td><td>July 22, 2026</td></tr></table>"
    assert [(r["case_number"], r["debtor"], r["agent_raw"], r["date_filed"]) for r in spool.assignment_tables(blobs(spark, headers)).collect()] == [("26-10002", "Bar", "Epiq", "July 22, 2026")]
    lines = spark.createDataFrame([("p", "1234 IN RE: Alpha Beta\n1234 Other caption\n  77 x\n5678 Total pending now")], "path string, text string")
    assert [(r["mdl_number"], r["caption"]) for r in spool.numbered_lines(lines).collect()] == [("1234", "Alpha Beta")]


def test_stream_commits_once(spark, tmp_path):
    schema = "source_id string, natural_key string, published_at timestamp, status string"
    row = lambda s, k, d, st="OK": (s, k, d, st)
    write = lambda rows, n: spark.createDataFrame(rows, "source_id string, natural_key string, d string, status string").select("source_id", "natural_key", F.col("d").cast("timestamp").alias("published_at"), "status").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = store.VersionedStore(spark, f"file://{tmp_path}/store")
    run = lambda: ingest.commit_items(ingest.files(spark, f"{tmp_path}/in", schema), s, f"{tmp_path}/ck").awaitTermination()
    write([row("a", "1", "2026-01-02"), row("a", "1", "2026-01-02"), row("b", "9", "2026-01-01", "BROKEN")], 0)
    run()
    write([row("a", "1", "2026-01-02"), row("a", "2", "2025-12-01"), row("b", "9", "2026-01-01")], 1)  # late, and b again
    run()
    run()
    assert sorted((r["source_id"], r["natural_key"]) for r in s.read("item").collect()) == [("a", "1"), ("a", "2"), ("b", "9")]
    assert len(s.manifest()["item"]) == 2  # each batch has written its new rows only
    assert {r["source_id"]: str(r["value"])[:10] for r in s.read("watermark").collect()} == {"a": "2026-01-02", "b": "2026-01-01"}


def test_no_row_of_a_broken_source_is_lost(spark, tmp_path):
    s = store.VersionedStore(spark, f"file://{tmp_path}/store")
    batch = lambda *rows: spark.createDataFrame([(a, b, None, c) for a, b, c in rows], "source_id string, natural_key string, published_at timestamp, status string")
    kept = lambda: sorted((r["source_id"], r["natural_key"]) for r in s.read("item").collect())
    first = batch(("a", "1", "OK"), ("a", "2", "BROKEN"), ("b", "1", "OK"))
    for _ in range(2):  # redone
        ingest.commit_batch(first, s)
        assert kept() == [("b", "1")] and s.read("pending").count() == 2
    ingest.commit_batch(batch(("b", "2", "OK")), s)
    assert kept() == [("a", "1"), ("b", "1"), ("b", "2")] and s.read("pending").count() == 1
    ingest.commit_batch(batch(("a", "2", "OK")), s)
    assert kept() == [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")] and s.read("pending").count() == 0


def test_enrollments_and_marks(spark):
    events = [("x", 1, "candidate"), ("x", 3, "enroll"), ("x", 5, "alert"), ("x", 7, "alert"), ("y", 2, "enroll"), ("z", 1, "candidate"), ("w", 4, "candidate"), ("w", 3, "enroll"), ("v", 1, "candidate"), ("v", 2, "alert"), ("v", 3, "drop")]
    got = {r["index_number"]: tuple(r)[1:] for r in store.enrollments(spark.createDataFrame(events, "index_number string, at int, kind string")).collect()}
    assert got == {"x": ("confirmed", 1, 3, 5, 7, 2), "z": ("candidate", 1, None, None, None, 0), "w": ("candidate", 4, None, None, None, 0), "v": ("dropped", 1, None, 2, 2, 1)}
    rows, delta = spark.createDataFrame([(1, None, "p"), (2, "old", "q")], "k int, note string, other string"), spark.createDataFrame([(1, "new"), (2, None), (3, "x")], "k int, note string")
    assert sorted(map(tuple, store.mark(rows, delta, ["k"], ["note"]).collect())) == [(1, "new", "p"), (2, "old", "q")]


def test_webhooks(spark):
    raw = spark.createDataFrame([('{"webhook": {"event_type": 1}, "payload": {"results": [{"docket": 7}]}}', ""), ('{"payload": {"docket_id": "x"}}', "k")], "body string, header_key string")
    got = ingest.webhook_rows(raw).collect()
    assert [(r["event_type"], r["docket_id"]) for r in got] == [(1, 7), (None, None)] and got[0]["idempotency_key"].startswith("sha256:") and got[1]["idempotency_key"] == "k"
