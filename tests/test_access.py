"""Connectors, expectations, runs, exports and extractor batches on small pinned cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera import __main__ as command_line
from tessera import queries
from tessera.operators import access, extracts, store
from tessera.plans import expectations, settings, tasks
from tessera.sinks import export
from tessera.sources import connectors, robots
from tessera.streaming import orchestrate

from .test_core import blobs, values


def test_expectations_fail_at_the_first(spark):
    wanted = {"a": expectations.Expectation(("text/html",), 3, 8, ("<p",), ("id=1",))}
    rows = [("a", "text/plain", "x"), ("a", "text/html", "x"), ("a", "text/html", "x" * 9), ("a", "text/html", "xxxx"), ("a", "text/html", "<p>xx"), ("a", "text/html", "<pid=1"), ("b", None, None), ("a", None, None)]
    df = spark.createDataFrame([(i, s, k, None if c is None else bytearray(c.encode())) for i, (s, k, c) in enumerate(rows)], "i int, source_id string, content_type string, content binary")
    got = [r["failure"] for r in expectations.checked(df, wanted).orderBy("i").collect()]
    assert got == ["content type text/plain", "too short: 1", "too long: 9", "no marker <p", "no anchor id=1", None, None, "content type "]
    text = "x\n" * 59 + "Form Type\n"
    assert values(spark, expectations.has_index_header, [text, "x\n" + text, ""]) == [True, False, False]
    assert values(spark, lambda x: expectations.is_placeholder(x, ("you@example.com",)), ["You@example.com ", "a@b.org", None]) == [True, False, True]
    assert len(expectations.EXPECTATIONS) == 13


def test_pages_of_courts_and_vendors(spark):
    page = lambda n, *ids: json.dumps({"next": n, "results": [{"id": i, "full_name": f"{i} {n}", "pacer_has_rss_feed": i != "b"} for i in ids]})
    pages = spark.createDataFrame([("p1", bytearray(page("u", "a", "b").encode()), "F", 1), ("p2", bytearray(page(None, "b").encode()), "F", 2), ("p3", bytearray(page("u", "c").encode()), "S", 2), ("p4", bytearray(b"x"), "S", 9)], "path string, content binary, jurisdiction string, page int")
    courts, ends = connectors.court_pages(pages, 3)
    assert sorted((r["court_id"], r["full_name"], r["has_rss"]) for r in courts.collect()) == [("a", "a u", True), ("b", "b None", False), ("c", "c u", True)]
    assert {r["jurisdiction"]: r["hit_page_limit"] for r in ends.collect()} == {"F": False, "S": True}
    directory = "<table><tr><td>Epiq Systems<br>1 Road<br><a href='http://e'>site</a></td><td>Hi<br>x</td><td>one line</td></tr></table><table><tr><th>Case No.</th><th>Claims Agent</th></tr><tr><td>26-1<br>x</td><td>Kroll Inc<br>y</td></tr></table>"
    assert [(r["vendor_name"], r["details"], r["href"]) for r in connectors.vendor_directory(blobs(spark, directory)).collect()] == [("Epiq Systems", "1 Road site", "http://e")]
    assert connectors.coverage_note(spark.range(3), 50, "states").first()["note"] == "3 of 50 states"


def test_registry_and_plans(spark):
    made = connectors.Registry()
    made.register("a", lambda days=3: connectors.Connector("a", lambda s, _: s.range(days), lambda x: x))
    made.register("w", lambda: connectors.Connector("w", lambda s, _: s.range(1), lambda x: x, "weekly"))
    with pytest.raises(ValueError):
        made.register("a", lambda: None)
    with pytest.raises(KeyError):
        made.build("z")
    both = [made.build("a", days=2), made.build("w")]
    assert both[0].plan(spark, None).count() == 2
    assert [c.source_id for c in connectors.due(both)] == ["a"] and [c.source_id for c in connectors.due(both, weekly=True, only=["w"])] == ["w"]
    assert [r["offset"] for r in connectors.offsets(spark, 3).orderBy("page").collect()] == [0, 100, 200]


def test_agents_from_a_file(tmp_path, spark):
    (tmp_path / "agents.toml").write_text('[[agent]]\nid = "x"\naliases = ["X Corp", "x & y"]\n')
    agents = tasks.load_agents(str(tmp_path / "agents.toml"))
    assert values(spark, lambda c: tasks.vendor(c, agents), ["the X corp.", "X and Y Ltd", "Epiq"]) == ["x", "x", "unmapped"]


def test_a_run_goes_on_after_a_connector_that_fails(spark, tmp_path):
    rows = lambda x: x.select(F.col("path").alias("natural_key"), F.col("content").cast("string").alias("title"), F.lit("jury verdict").alias("body"), F.lit(None).cast("timestamp").alias("published_at"))
    plan = lambda s, hint: s.createDataFrame([(hint or "start",)], "task_key string")
    fetch = lambda tasks_: tasks_.select(F.col("task_key").alias("path"), F.lit("u").alias("url"), F.encode(F.lit("body"), "UTF-8").alias("content"), F.lit("text/html").alias("content_type"))
    bad = lambda x: x.withColumn("natural_key", F.raise_error(F.lit("no such page")))
    made = [connectors.Connector("bad", plan, bad), connectors.Connector("short", plan, rows), connectors.Connector("fine", plan, rows), connectors.Connector("empty", plan, lambda x: rows(x).limit(0)), connectors.Connector("closed", plan, rows)]
    kept = store.VersionedStore(spark, f"file://{tmp_path}/store")
    run = lambda n: orchestrate.run(spark, n, made, fetch, kept, {"closed": "prohibited"}, {"short": expectations.Expectation(min_bytes=100)})
    report = run("r1")
    told = {o[1]: (o[2], o[3], o[4]) for o in report.outcomes}
    assert told == {"bad": ("BROKEN", 0, 0), "short": ("BROKEN", 0, 0), "fine": ("HEALTHY", 1, 1), "empty": ("BROKEN", 0, 0)}
    assert report.blocked == [("closed", "prohibited")] and not report.ok
    assert [(r["source_id"], r["event_class"]) for r in kept.read("item").collect()] == [("fine", "verdict")]
    orchestrate.remember(kept, "fine", "next")
    again = {o[1]: o[4] for o in run("r2").outcomes}
    assert again["fine"] == 1 and kept.read("item").count() == 2  # the plan has taken up what was remembered
    summary = {r["run_id"]: (r["total_new"], r["failures"], r["ok"]) for r in access.roll_up(kept.read("run_task")).collect()}
    assert summary == {"r1": (1, 3, False), "r2": (1, 3, False)}
    text = export.run_report("r1", [r.asDict() for r in report.frame(spark).collect()], report.blocked, ["stale"])
    assert text.index("## Failures") < text.index("## Blocked") < text.index("## Warnings") and "| fine | HEALTHY | 1 | 1 |" in text


def test_reports_of_ranked_rows(spark, tmp_path):
    rows = spark.createDataFrame([(2, "B v. <C>", "a </script> b", 0.5), (1, "A", None, 0.75), (None, "dup", "x", 0.1)], "rank_in_run int, case_caption string, description string, score double")
    text, page = export.digest(rows, ["beware"])
    assert text.startswith("1. A (0.750): \n2. B v. <C> (0.500)") and "&lt;C&gt;" in page and "beware" in text
    board = export.dashboard(rows, ["rank_in_run", "case_caption", "description"], {"items": 3}, ["w"])
    assert "a <\\/script> b" in board and "dup" not in board and "items: 3" in board
    where = export.publish(spark, f"file://{tmp_path}", "0123456789abcdef", {"index.html": board})
    manifest = json.loads((tmp_path / "0123456789abcdef" / "manifest.json").read_text())
    assert where.endswith("0123456789abcdef") and manifest["index.html"]["bytes"] == len(board.encode())
    for folder, secret in ((f"file://{tmp_path}", "short"), ("https://x", "0123456789abcdef")):
        with pytest.raises(ValueError):
            export.publish(spark, folder, secret, {})


def test_artifacts_and_index(spark, tmp_path):
    content = [b"small", b"x" * 5000, b"small", None]
    raw = spark.createDataFrame([("s", f"u{i}.json", None, None if c is None else bytearray(c)) for i, c in enumerate(content)], "source_id string, url string, content_type string, content binary")
    stored = export.addressed(raw)
    assert sorted((r["byte_size"], r["compressed"], r["ext"]) for r in stored.collect()) == [(0, False, "json"), (5, False, "json"), (5000, True, "json")]
    assert sorted(bytes(r["content"]) for r in export.unpacked(stored).collect()) == sorted([b"", b"small", b"x" * 5000])
    with pytest.raises(Exception, match="damaged"):
        export.unpacked(stored.withColumn("sha256", F.lit("0" * 64))).collect()
    items = spark.createDataFrame([("a", "Jury verdict, jury"), ("b", "verdict"), ("c", None)], "item_uid string, body string")
    export.write_index(export.postings(items, F.col("body")), f"{tmp_path}/index", 4)
    index = spark.read.parquet(f"{tmp_path}/index")
    assert [tuple(r) for r in export.search(index, ["JURY", "verdict"], 4).collect()] == [("a", 3)]
    assert sorted(r["item_uid"] for r in export.search(index, ["verdict"], 4).collect()) == ["a", "b"]


def test_extractor_batches(spark):
    lines = [json.dumps({"custom_id": "u" * 60, "text": '{"a": 1}'}), json.dumps({"custom_id": "lost", "text": "{bad"}), json.dumps({"custom_id": "none"}), "torn {"]
    items = spark.createDataFrame([("u" * 64,), ("v",)], "item_uid string")
    got = {r["custom_id"]: (r["item_uid"], r["payload_json"], r["error"]) for r in extracts.results(spark.createDataFrame([(x,) for x in lines], "value string"), items).collect()}
    assert got == {"u" * 60: ("u" * 64, '{"a": 1}', None), "lost": ("lost", None, "unparsable payload"), "none": ("none", None, "empty result")}
    schema = extracts.hardened({"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "string"}}}, "c": {"type": "array", "items": {"type": "object", "properties": {}}}}})
    assert schema["required"] == ["a", "c"] and schema["properties"]["a"] == {"type": "object", "properties": {"b": {"type": "string"}}, "additionalProperties": False, "required": ["b"]}
    late = spark.createDataFrame([("patent infringement suit", None, None), ("x", "indictment for bid-rigging", "")], "case_caption string, summary string, posture string")
    assert [(r["late_excluded"], r["late_area"]) for r in extracts.late_screen(late).collect()] == [(True, "intellectual_property"), (False, "none")]


def test_sorts_and_display(spark):
    rows = spark.createDataFrame([(1, "not named in document", "Discovery", 5.0), (2, "Alpha", "Closed", None), (3, "beta", "Nowhere", 5.0)], "rank_in_run int, counsel string, stage string, damages_usd double")
    order = lambda key, down: [r["rank_in_run"] for r in sorted(access.sorted_view(rows, key, down, 9).collect(), key=lambda r: r["place"])]
    assert order("counsel", False) == [2, 3, 1] and order("stage", False) == [2, 1, 3] and order("damages", True) == [1, 3, 2] and order("rank", True) == [3, 2, 1]
    assert len(access.SORTS) == 11 and len(access.STAGE_ORDER) == 20
    firms = spark.createDataFrame([(["A", "", "B"], 1), ([], 2), (None, None)], "f array<string>, v int")
    assert [r[0] for r in firms.select(access.counsel(F.col("f"), F.col("v"))).collect()] == ["A; B", "not named in document", "not captured (pre-v2 extraction)"]
    shown = access.display(spark.createDataFrame([(2, " ", "Texas", None)], "cluster_size int, court string, venue string, damages_usd double")).first()
    assert (shown["document_count"], shown["court_display"], shown["damages_sort_key"]) == (2, "Texas", 0.0)
    marks = spark.createDataFrame([("s", "t", "v", '["a","b"]'), ("s", "u", None, "torn")], "source_id string, task_key string, value string, seen_keys string")
    assert [access.get_watermark(marks, "s", k).first()["seen_keys"] for k in ("t", "u")] == [["a", "b"], []]


def test_settings_and_command_line(tmp_path, spark, capsys):
    file = tmp_path / "s.toml"
    file.write_text('purpose = "research"\ncap = 5\n')
    defaults = {"purpose": "production", "cap": 400, "opt_in": False}
    assert settings.load(defaults, str(file), {"TESSERA_CAP": "7", "TESSERA_OPT_IN": "yes"}) == {"purpose": "research", "cap": 7, "opt_in": True}
    with pytest.raises(ValueError):
        settings.load(defaults, None, {"TESSERA_PURPOSE": "fun"})
    file.write_text("other = 1\n")
    with pytest.raises(KeyError):
        settings.load(defaults, str(file), {})
    assert command_line.main(["coverage", "/root/testdata/sf0.001", "--limit", "2"]) == 0
    assert "confidence" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        command_line.main(["nothing", "/x"])
    assert set(command_line.VERBS.values()) <= set(queries.QUERIES)


def test_robots_without_anything_to_say(spark):
    files = spark.createDataFrame([("a", None), ("b", "User-agent: GPTBot\nSitemap: x\nDisallow: /\n"), ("c", "User-agent: GPTBot\nDisallow:\nDisallow: /\n")], "path string, text string")
    assert {r["path"]: r["ai_signal"] for r in robots.ai_signals(files).collect()} == {"a": None, "b": None, "c": "blocks AI crawlers: gptbot"}
