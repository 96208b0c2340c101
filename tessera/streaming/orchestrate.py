"""One run over connectors: plan, fetch, check, parse, filter, classify, commit; a connector that fails ends only itself."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.text import item_uid
from ..operators import health
from ..operators.store import VersionedStore, insert_ignore
from ..plans.expectations import EXPECTATIONS, Expectation, checked
from ..sources.connectors import Connector

OUTCOME = "run_id string, source_id string, verdict string, rows_parsed long, rows_new long, is_partial boolean, note string"


@dataclass
class Report:
    """outcomes: one tuple of OUTCOME a connector that ran; blocked: sources that policy forbids, and why."""

    run_id: str
    outcomes: list[tuple] = field(default_factory=list)
    blocked: list[tuple[str, str]] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return all(o[2] != "BROKEN" for o in self.outcomes)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.outcomes, OUTCOME)


def _collect(spark: SparkSession, run_id: str, connector: Connector, fetch: Callable[[DataFrame], DataFrame], store: VersionedStore, expectations: Mapping[str, Expectation]) -> tuple:
    marks = store.read("plan_watermark")
    hint = marks.where(F.col("source_id") == connector.source_id).select("value").first() if marks is not None else None
    artifacts = fetch(connector.plan(spark, hint[0] if hint else None)).withColumn("source_id", F.lit(connector.source_id)).persist()
    try:
        failed = checked(artifacts, expectations).where("failure is not null").select("failure").first()
        if failed:
            return (run_id, connector.source_id, "BROKEN", 0, 0, False, failed[0])
        rows = connector.parse(artifacts).withColumn("source_id", F.lit(connector.source_id))
        parsed = rows.withColumn("item_uid", item_uid(F.col("source_id"), F.col("natural_key"))).persist()
        try:
            n, bodies = parsed.count(), artifacts.where("octet_length(content) > 0").limit(1).count() > 0
            old = store.read("item")
            told = classify.with_event(parsed, F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))))
            new = told.dropDuplicates(["source_id", "natural_key"]) if old is None else insert_ignore(old, told, ["source_id", "natural_key"])
            verdict = spark.range(1).select(health.verdict(F.lit(n), F.lit(1), F.lit(False), F.lit(bodies), F.lit(not bodies)).alias("v")).select("v.*").first()
            if verdict["verdict"] == "BROKEN":
                return (run_id, connector.source_id, "BROKEN", n, 0, False, verdict["note"])
            before = old.count() if old is not None else 0
            store.commit(append={"item": new})
            added = store.read("item").count() - before
            partial = parsed.where("truncated").limit(1).count() > 0 if "truncated" in parsed.columns else False
            return (run_id, connector.source_id, verdict["verdict"], n, added, partial, f"parsed {n}, {added} new")
        finally:
            parsed.unpersist()
    finally:
        artifacts.unpersist()


def run(
    spark: SparkSession, run_id: str, connectors: Sequence[Connector], fetch: Callable[[DataFrame], DataFrame], store: VersionedStore,
    blocked: Mapping[str, str] = {}, expectations: Mapping[str, Expectation] = EXPECTATIONS,  # noqa: B006
) -> Report:
    """Run connectors one after another. fetch gives the artifacts (path, url, content, content_type) of a plan's tasks.

    blocked: sources that may not be read, and why. An error of a connector is its outcome; its items
    and watermark stay as they were, and the others go on. The outcomes are kept in `run_task`.
    """
    report = Report(run_id)
    for c in connectors:
        if c.source_id in blocked:
            report.blocked.append((c.source_id, blocked[c.source_id]))
            continue
        try:
            report.outcomes.append(_collect(spark, run_id, c, fetch, store, expectations))
        except Exception as e:  # noqa: BLE001  one bad connector can't end the run
            report.outcomes.append((run_id, c.source_id, "BROKEN", 0, 0, False, f"{type(e).__name__}: {str(e)[:300]}"))
    if report.outcomes:
        store.commit(append={"run_task": report.frame(spark)})
    return report


def remember(store: VersionedStore, source_id: str, value: str) -> None:
    """Keep what the source's next plan needs, such as the address of a document found on a landing page."""
    spark = store.spark
    mark = spark.createDataFrame([(source_id, value)], "source_id string, value string")
    old = store.read("plan_watermark")
    store.commit({"plan_watermark": mark if old is None else old.where(F.col("source_id") != source_id).unionByName(mark)})
