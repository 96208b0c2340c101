"""Connectors: how a source's artifacts become items, and what is asked of it and when."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import item_uid, strip
from . import spool


# --- Feeds ---------------------------------------------------------------------------------------
def configured_feeds(artifacts: DataFrame, specs: DataFrame) -> DataFrame:
    """Items of feeds as their specs say. artifacts: url, path, content; specs: source_id, url, key_field (guid, link or creator).

    One row an entry with a key; a feed without a spec gives none.
    """
    known = artifacts.join(F.broadcast(specs), "url")  # a row for each configured feed
    rows = spool.feeds(known.select("path", "content"), "guid").drop("natural_key")
    rows = rows.join(known.select("path", "source_id", "url", "key_field"), "path")
    key = F.when(F.col("key_field") == "creator", F.coalesce("creator", "guid", "link", "title")).when(F.col("key_field") == "link", F.coalesce("link", "guid", "title")).otherwise(F.coalesce("guid", "link", "title"))
    return rows.withColumn("natural_key", key).where("natural_key is not null").withColumn("item_uid", item_uid(F.col("source_id"), F.col("natural_key")))


def namespaced_feeds(entries: DataFrame, feeds: DataFrame, source_id: str = "state_ag") -> DataFrame:
    """entries (url, natural_key, title, ...) with their state's name before key and title; an unknown url is of state ??.

    feeds: url, state, status; those that aren't verified are not read.
    """
    rows = entries.join(F.broadcast(feeds.select("url", "state", "status")), "url", "left").where("status is null or status = 'verified'")
    state = F.coalesce("state", F.lit("??"))
    return rows.withColumns({"state": state, "source_id": F.lit(source_id), "natural_key": F.concat(state, F.lit(":"), "natural_key"), "title": F.concat(F.lit("["), state, F.lit("] "), F.coalesce("title", F.lit("")))}).drop("status")


# --- Case pages ----------------------------------------------------------------------------------
#: Words of a document's label and its event class, in the order they are tried.
LABEL_CLASSES = (
    ("proposed final judgment", "settlement_proposed"), ("final judgment", "judgment_entered"), ("competitive impact statement", "settlement_proposed"),
    ("consent decree", "settlement_proposed"), ("stipulation", "settlement_proposed"), ("asset preservation", "settlement_proposed"),
    ("hold separate", "settlement_proposed"), ("complaint", "case_filed"), ("response to public comment", "settlement_proposed"),
)


def label_class(label: Column) -> Column:
    """Event class of a document's label: a proposed judgment is told before an entered one."""
    out, low = F.lit("other"), F.lower(F.coalesce(label, F.lit("")))
    for words, kind in reversed(LABEL_CLASSES):
        out = F.when(F.contains(low, F.lit(words)), kind).otherwise(out)
    return out


class _CaseRows(HTMLParser):
    """Rows of div.views-row: the first link or heading is the case, the links below it are its documents."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[str, list[tuple[str, str]], str]] = []
        self.depth = 0
        self.heading = self.link = None
        self.title = self.date = ""
        self.documents: list[tuple[str, str]] = []
        self.text: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        known = dict(attrs)
        if tag == "div" and not self.depth and "views-row" in (known.get("class") or "").split():
            self.depth, self.title, self.documents, self.text = 1, "", [], []
        elif tag == "div" and self.depth:
            self.depth += 1
        elif self.depth and tag in ("h2", "h3", "h4"):
            self.heading = []
        elif self.depth and tag == "a" and self.heading is None:
            self.link = (known.get("href") or "", [])

    def handle_data(self, data: str) -> None:
        if not self.depth:
            return
        self.text.append(data)
        if self.heading is not None:
            self.heading.append(data)
        elif self.link is not None:
            self.link[1].append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("h2", "h3", "h4") and self.heading is not None:
            self.title, self.heading = self.title or " ".join("".join(self.heading).split()), None
        elif tag == "a" and self.link is not None:
            label = " ".join("".join(self.link[1]).split())
            if label:
                self.documents.append((label, self.link[0]))
            self.link = None
        elif tag == "div" and self.depth:
            self.depth -= 1
            if not self.depth and self.title:
                self.rows.append((self.title, self.documents, " ".join("".join(self.text).split())))


_LONG_DATE = re.compile(r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}")


def _cases(content: bytes) -> list[tuple]:
    parser = _CaseRows()
    parser.feed(content.decode("utf-8", "replace"))
    parser.close()
    out = []
    for i, (title, documents, text) in enumerate(parser.rows):
        date = _LONG_DATE.search(text)
        out += [(i, j, title, label, href, date[0] if date else None) for j, (label, href) in enumerate(documents)]
    return out


def case_documents(artifacts: DataFrame) -> DataFrame:
    """A row for each document of each case row of a page; rows without a case's title give none."""
    rows = spool._parsed(artifacts, _cases, "case_place long, document_place long, case_title string, label string, href string, dated string")
    return rows.select("path", F.format_string("row[%d]/doc[%d]", "case_place", "document_place").alias("locator"), "case_title", "label", "href", label_class(F.col("label")).alias("event_class"), F.to_date(F.try_to_timestamp(F.regexp_replace("dated", r"\s+", " "), F.lit("MMMM d, yyyy"))).alias("published_on"))


# --- JSON ----------------------------------------------------------------------------------------
def packages(artifacts: DataFrame, courts: Sequence[str] = (), civil_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Packages of the wanted courts and kinds, and per page (path) how many were given, kept and skipped for which reason.

    A page all of whose packages are skipped is as sound as any; an empty list of courts wants all.
    """
    schema = "count long, packages array<struct<packageId: string, title: string, dateIssued: string>>"
    pages = spool._json(artifacts, schema)
    rows = pages.select("path", F.posexplode_outer("j.packages").alias("place", "p")).select("path", "place", "p.packageId", "p.title", F.to_date(F.try_to_timestamp("p.dateIssued")).alias("issued_on"), spool.package_parts(F.coalesce("p.packageId", F.lit(""))).alias("parts"))
    other_kind = F.col("packageId").isNotNull() & (F.col("parts.case_type") != "cv") & F.lit(civil_only)
    other_court = F.col("packageId").isNotNull() & (~F.col("parts.court").isin(*courts) if courts else F.lit(False))
    rows = rows.withColumns({"skipped": F.when(other_kind, "kind").when(other_court, "court")})
    kept = rows.where("packageId is not null and skipped is null").select("path", "place", F.col("packageId").alias("natural_key"), "title", "issued_on", "parts.court", "parts.case_type", "parts.case_number")
    counts = rows.groupBy("path").agg(F.count("packageId").alias("given"), F.count_if(F.col("packageId").isNotNull() & F.col("skipped").isNull()).alias("kept"), F.count_if(F.col("skipped") == "kind").alias("skipped_kind"), F.count_if(F.col("skipped") == "court").alias("skipped_court"))
    return kept, counts


def court_pages(artifacts: DataFrame, most_pages: int = 12) -> tuple[DataFrame, DataFrame]:
    """Courts of an endpoint's pages, one row an id (the last page's), and per jurisdiction whether its pages end before the limit.

    artifacts: path, content, jurisdiction, page (1, 2, ...). Pages beyond the limit aren't read.
    """
    schema = "next string, results array<struct<id: string, full_name: string, pacer_has_rss_feed: boolean, pacer_rss_entry_types: string>>"
    read = artifacts.where(F.col("page") <= most_pages).select("jurisdiction", "page", F.from_json(F.make_valid_utf8(F.col("content").cast("string")), schema, {"mode": "PERMISSIVE"}).alias("j"))
    rows = read.select("jurisdiction", "page", F.inline("j.results")).where("id is not null")
    courts = rows.groupBy("id").agg(F.max_by(F.struct("full_name", "jurisdiction", "pacer_has_rss_feed", "pacer_rss_entry_types"), "page").alias("c")).select(F.col("id").alias("court_id"), "c.full_name", "c.jurisdiction", F.col("c.pacer_has_rss_feed").alias("has_rss"), F.col("c.pacer_rss_entry_types").alias("entry_types"))
    ends = read.groupBy("jurisdiction").agg(F.max_by(F.col("j.next").isNotNull(), "page").alias("hit_page_limit"))
    return courts, ends


def case_url(provide_link: Column, is_legacy: Column, vanity: Column, slug: Column, host: str, legacy_host: str) -> Column:
    """Address of a case, if the source provides one: its host by age, its slug by what is filled in."""
    name = F.coalesce(F.nullif(strip(vanity), F.lit("")), F.nullif(strip(slug), F.lit("")))
    base = F.when(F.coalesce(is_legacy, F.lit(0)) == 1, legacy_host).otherwise(host)
    return F.when((F.coalesce(provide_link, F.lit(0)) == 1) & name.isNotNull(), F.concat(base, F.lit("/"), name))


# --- Two stages, kinds of content ----------------------------------------------------------------
def linked_document(html: Column, pattern: str) -> Column:
    """The first href of a landing page that a pattern is found in; the next run's plan fetches it."""
    links = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    return F.get(F.filter(links, lambda x: x.rlike(pattern)), F.lit(0))


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


def vendor_directory(artifacts: DataFrame) -> DataFrame:
    """Vendors of pages that list them in layout cells: cells of two lines at least whose first is a name of 4 to 110 characters.

    Tables whose headers name a case number and an agent are assignments, not directories.
    """

    def parse(content: bytes) -> list[tuple]:
        out = []
        for table in re.findall(r"(?is)<table\b.*?</table>", content.decode("utf-8", "replace")):
            cells = re.findall(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>", table)
            plain = [[x for x in (" ".join(re.sub(r"<[^>]+>", " ", y).split()) for y in re.split(r"(?i)<br\s*/?>|</p>|</div>|\n", c)) if x] for c in cells]
            headers = [" ".join(c) for c in plain[: len(re.findall(r"(?is)<th\b", table))]]
            if {"case_number", "agent"} <= set(spool.roles(headers)):
                continue
            for c, raw in zip(plain, cells, strict=True):
                if len(c) >= 2 and 4 <= len(c[0]) <= 110:
                    link = re.search(r"""(?is)href\s*=\s*["']([^"']+)""", raw)
                    out.append((c[0], " ".join(c[1:]), link[1] if link else None))
        return out

    return spool._parsed(artifacts, parse, "vendor_name string, details string, href string")


def coverage_note(covered: DataFrame, whole: int, what: str) -> DataFrame:
    """One row: how many of all there are a source covers, as a sentence. covered: a row for each."""
    n = F.count("*")
    return covered.agg(n.alias("covered"), F.lit(whole).alias("whole"), F.format_string(f"%d of {whole} {what}", n).alias("note"))


def read_message(artifacts: DataFrame) -> DataFrame:
    """Any sender's message, for calibration."""
    return spool.alerts(artifacts, (), require_trusted=False)


# --- Plans and the registry ----------------------------------------------------------------------
def offsets(spark: SparkSession, pages: int, size: int = 100) -> DataFrame:
    return spark.range(pages).select(F.col("id").alias("page"), (F.col("id") * size).alias("offset"), F.concat(F.lit("page:"), F.col("id").cast("string")).alias("task_key"))


def static_tasks(spark: SparkSession, urls: Mapping[str, str]) -> DataFrame:
    """A task for each named address."""
    return spark.createDataFrame(list(urls.items()), "task_key string, url string")


@dataclass(frozen=True)
class Connector:
    """A source: what it asks for, how its artifacts become rows, how often it runs (daily or weekly)."""

    source_id: str
    plan: Callable[[SparkSession, str | None], DataFrame]
    parse: Callable[[DataFrame], DataFrame]
    cadence: str = "daily"


class Registry:
    """Builders of connectors by name; parameters are given when one is built."""

    def __init__(self) -> None:
        self.builders: dict[str, Callable[..., Connector]] = {}

    def register(self, name: str, build: Callable[..., Connector]) -> None:
        if name in self.builders:
            raise ValueError(f"{name} is registered already")
        self.builders[name] = build

    def build(self, name: str, **parameters: object) -> Connector:
        if name not in self.builders:
            raise KeyError(f"no connector {name}; there are {', '.join(sorted(self.builders))}")
        return self.builders[name](**parameters)


def due(connectors: Sequence[Connector], weekly: bool = False, only: Sequence[str] = ()) -> list[Connector]:
    """Connectors of a run: weekly ones only if asked, and only those named if any are."""
    return [c for c in connectors if (weekly or c.cadence != "weekly") and (not only or c.source_id in only)]


