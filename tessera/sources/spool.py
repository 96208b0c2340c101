"""Parsers of collected artifacts: feeds, JSON pages, line indexes, HTML tables, mail. Input: rows of (path, content)."""

from __future__ import annotations

import email
import email.policy
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, collapse, moment, strip
from ..plans.tasks import normal_text


def artifacts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "content")


def _parsed(spool: DataFrame, parse: Callable[[bytes], list[tuple]], schema: str) -> DataFrame:
    """Rows of parse(content) beside their path and place; a file that doesn't parse gives none."""
    names = [c.split()[0] for c in re.split(r",\s*(?![^<]*>)", schema)]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(p, i, *row) for p, c in zip(batch["path"], batch["content"], strict=True) for i, row in enumerate(parse(bytes(c or b"")))]
            yield pd.DataFrame(out, columns=["path", "place", *names])

    return spool.mapInPandas(rows, f"path string, place long, {schema}")


# --- Feeds ---------------------------------------------------------------------------------------
def _entries(content: bytes) -> list[tuple]:
    try:
        root = ElementTree.fromstring(content.lstrip())
    except ElementTree.ParseError:
        return []
    bare = lambda e: e.tag.rpartition("}")[2]
    first = lambda e, *names: next((c.text for n in names for c in e if bare(c) == n and (c.text or "").strip()), None)
    out = []
    for e in root.iter():
        if bare(e) == "item":
            guid = next((c for c in e if bare(c) == "guid"), None)
            out.append((guid.text if guid is not None else None, guid is None or guid.get("isPermaLink", "true") == "true", first(e, "link"), first(e, "title"), first(e, "description", "encoded"), first(e, "pubDate", "date"), first(e, "creator"), [c.text for c in e if bare(c) == "category" and c.text]))
    if not out:
        for e in root.iter():
            if bare(e) == "entry":
                links = [c for c in e if bare(c) == "link"]
                best = next((c.get("href") for c in links if c.get("rel", "alternate") == "alternate"), links[0].get("href") if links else None)
                out.append((first(e, "id"), False, best, first(e, "title"), first(e, "summary", "content"), first(e, "updated", "published"), None, [c.get("term") for c in e if bare(c) == "category" and c.get("term")]))
    return out


def feeds(spool: DataFrame, prefer: str = "guid") -> DataFrame:
    """RSS items, or Atom entries where there are none, with their natural key; entries without any key go."""
    rows = _parsed(spool, _entries, "guid string, is_permalink boolean, link string, title string, description string, published_raw string, creator string, categories array<string>")
    for c in ("guid", "link", "title", "description", "creator"):
        rows = rows.withColumn(c, blank_to_null(F.col(c)))
    order = {"creator": ["creator", "guid", "link", "title"], "link": ["link", "guid", "title"]}.get(prefer, ["guid", "link", "title"])
    return rows.withColumn("natural_key", F.coalesce(*order)).where("natural_key is not null").withColumn("published_at", moment(strip(F.col("published_raw"))))


# --- JSON pages ----------------------------------------------------------------------------------
HITS = "hits struct<total: struct<value: long, relation: string>, hits: array<struct<_id: string, _source: struct<form: string, items: array<string>, display_names: array<string>, ciks: array<string>, file_date: string, adsh: string>>>>"
#: Items of an 8-K that may tell of a case.
RELEVANT_ITEMS = ("1.01", "8.01", "2.05", "2.06")


def _json(spool: DataFrame, schema: str) -> DataFrame:
    return spool.select("path", F.from_json(F.make_valid_utf8(F.col("content").cast("string")), schema, {"mode": "PERMISSIVE"}).alias("j"))


def search_hits(spool: DataFrame) -> DataFrame:
    """Hits of full-text search pages, with whether an 8-K's items are relevant."""
    h = _json(spool, HITS).select("path", "j.hits.total", F.posexplode("j.hits.hits").alias("place", "h")).where("h._id is not null")
    s = F.col("h._source")
    items = F.coalesce(s["items"], F.array().cast("array<string>"))
    relevant = ~F.coalesce(s["form"], F.lit("")).startswith("8-K") | (F.size(items) == 0) | F.arrays_overlap(items, F.array(*[F.lit(i) for i in RELEVANT_ITEMS]))
    return h.select("path", "place", F.col("h._id").alias("natural_key"), s["form"].alias("form"), items.alias("items"), relevant.alias("relevant"), F.col("total.value").alias("slice_total"), (F.col("total.relation") == "gte").alias("saturated"))


def archive_url(accession: Column, cik: Column, file_id: Column, base: str) -> Column:
    """Address of a filing's document; empty if a part is missing."""
    name = F.split_part(file_id, F.lit(":"), F.lit(2))
    number = F.regexp_replace(cik, "^0+", "")
    return F.when(F.coalesce(accession, F.lit("")).eqNullSafe("") | F.coalesce(number, F.lit("")).eqNullSafe("") | F.coalesce(name, F.lit("")).eqNullSafe(""), "").otherwise(F.concat(F.lit(base), number, F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), name))


def docket_entries(spool: DataFrame) -> DataFrame:
    """Results of docket search pages; truncated tells that the server holds more than it gave."""
    schema = "count long, results array<struct<id: long, docket_id: long, docket_entry_id: long, description: string, entry_date_filed: string, absolute_url: string>>"
    pages = _json(spool, schema)
    return pages.select("path", "j.count", F.size("j.results").alias("n"), F.posexplode("j.results").alias("place", "r")).where("r.id is not null").select("path", "place", F.concat(F.lit("recap-doc:"), F.col("r.id").cast("string")).alias("natural_key"), "r.docket_id", "r.description", F.try_to_timestamp("r.entry_date_filed").alias("published_at"), (F.col("count") > F.col("n")).alias("truncated"))


def case_list(spool: DataFrame) -> DataFrame:
    """Lead cases with the names of their affiliates."""
    schema = "recordsTotal long, data array<struct<CASE_NO: string, CASE_ID: string, CASE_NAME: string, DEBTOR_NAME: string, sub_debtor: array<struct<DEBTOR_NAME: string>>>>"
    rows = _json(spool, schema).select("path", F.posexplode("j.data").alias("place", "d"))
    names = F.filter(F.transform(F.coalesce("d.sub_debtor", F.array().cast("array<struct<DEBTOR_NAME:string>>")), lambda x: strip(x["DEBTOR_NAME"])), lambda x: x != "")
    return rows.select("path", "place", F.coalesce(F.nullif("d.CASE_ID", F.lit("")), F.col("d.CASE_NO")).alias("natural_key"), F.col("d.CASE_NAME").alias("case_name"), names.alias("affiliates")).where("natural_key is not null")


def package_parts(package_id: Column) -> Column:
    """court, case_type and case_number of a package id such as USCOURTS-nysd-1_26-cv-01234."""
    court = F.split_part(package_id, F.lit("-"), F.lit(2))
    rest = F.regexp_extract(package_id, r"(\d+_)?(\d{2})-([a-z]{2,3})-(\d+)", 2), F.regexp_extract(package_id, r"(\d+_)?(\d{2})-([a-z]{2,3})-(\d+)", 3), F.regexp_extract(package_id, r"(\d+_)?(\d{2})-([a-z]{2,3})-(\d+)", 4)
    kind = F.coalesce(F.nullif(rest[1], F.lit("")), *[F.when(F.contains(package_id, F.lit(f"-{k}-")), k) for k in ("cv", "cr", "bk", "md")], F.lit(""))
    return F.struct(court.alias("court"), kind.alias("case_type"), F.when(rest[0] != "", F.concat_ws("-", *rest)).otherwise("").alias("case_number"))


# --- Lines and tables ----------------------------------------------------------------------------
#: Forms of interest in the daily index.
FORMS = ("8-K", "8-K/A", "10-Q", "10-K", "10-Q/A", "10-K/A")
INDEX_LINE = r"^(\S+(?: \S+)*?)\s{2,}(.+?)\s{2,}(\d{1,10})\s+(\d{8})\s+(edgar/\S+)\s*$"


def index_lines(spool: DataFrame) -> DataFrame:
    """Lines of a fixed-width index that have its shape; of_interest tells whether the form is wanted."""
    lines = spool.select("path", F.posexplode(F.split(F.make_valid_utf8(F.col("content").cast("string")), "\r?\n")).alias("place", "line")).where(F.col("line").rlike(INDEX_LINE))
    part = lambda i: F.regexp_extract("line", INDEX_LINE, i)
    return lines.select("path", "place", part(1).alias("form"), part(2).alias("company"), part(3).alias("cik"), F.to_date(F.try_to_timestamp(part(4), F.lit("yyyyMMdd"))).alias("date_filed"), part(5).alias("archive_path")).withColumn("of_interest", F.col("form").isin(*FORMS))


def numbered_lines(text: DataFrame) -> DataFrame:
    """mdl_number and caption of numbered lines of (path, text); the first line of a number counts."""
    line = F.posexplode(F.split("text", "\n")).alias("place", "line")
    shape = r"(?i)^\s*(\d{3,5})\s+(?:IN RE:?\s*)?(.*)$"
    rows = text.select("path", line).where(F.col("line").rlike(shape)).select("path", "place", F.regexp_extract("line", shape, 1).alias("mdl_number"), collapse(F.regexp_extract("line", shape, 2)).alias("caption"))
    rows = rows.where((F.length("caption") >= 6) & ~F.lower("caption").rlike("^(page|total|as of)"))
    return rows.groupBy("path", "mdl_number").agg(F.min_by("caption", "place").alias("caption"))


#: Words of headers that name a column's role, in the order they are tried.
ROLES = (
    ("case", "case_number"), ("debtor", "debtor"), ("title", "debtor"), ("claims agent", "agent"), ("link to claims agent website", "agent"), ("agent", "agent"),
    ("date filed", "date_filed"), ("filed", "date_filed"), ("vicinage", "vicinage"), ("judge", "judge"),
)


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.tables: list[list[list[tuple[str, str]]]] = []
        self.depth = 0
        self.cell: list[str] | None = None
        self.href = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell, self.href = [], ""
        elif tag == "a" and self.cell is not None and not self.href:
            self.href = dict(attrs).get("href") or ""
        elif tag in ("br", "p", "div") and self.cell is not None:
            self.cell.append("\n")

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append((" ".join("".join(self.cell).split()), self.href))
            self.cell = None


def roles(headers: list[str]) -> dict[str, int]:
    """Column of each role: the first column that claims it; a column whose role is taken tries its next."""
    out: dict[str, int] = {}
    for i, h in enumerate(headers):
        name = normal_text(h)
        for word, role in ROLES:
            if word in name and role not in out:
                out[role] = i
                break
    return out


def _assignments(content: bytes) -> list[tuple]:
    parser = _Tables()
    parser.feed(content.decode("utf-8", "replace"))
    out = []
    for table in parser.tables:
        at = roles([c for c, _ in table[0]]) if table else {}
        if not {"case_number", "agent"} <= set(at):
            continue
        for row in table[1:]:
            get = lambda role: row[at[role]][0] if role in at and at[role] < len(row) else ""  # noqa: E731,B023
            number = re.search(r"\b(\d{2}-\d{4,6})(?:-[A-Za-z]{2,4})?\b", get("case_number"))
            if number:
                out.append((number[1], get("case_number"), get("debtor"), get("agent"), row[at["agent"]][1] if at["agent"] < len(row) else "", get("date_filed"), get("judge")))
    return out


def assignment_tables(spool: DataFrame) -> DataFrame:
    """Rows of HTML tables whose headers name a case number and an agent."""
    return _parsed(spool, _assignments, "case_number string, case_number_raw string, debtor string, agent_raw string, agent_url string, date_filed string, judge string")


# --- Mail ----------------------------------------------------------------------------------------
#: Labels of an alert's fields, as patterns.
LABELS = (
    "index number", r"index no\.?", "case name", "caption", "court", "county", "appearance date", "appearance type", "justice", "judge", "document", "date filed", "filed",
    "efiling status", "status", "motion", "notification type",
)
#: An index number, with or without its label.
INDEX_NUMBER = r"(?i)\b(?:index\s*(?:no\.?|number)?\s*[:#]?\s*)?(\d{3,7}\s*/\s*(?:19|20)\d{2})\b"
#: Words that tell what an alert is about, in the order they are tried.
EVENT_WORDS = (
    ("decision", "decision"), ("order", "decision"), ("judgment", "judgment"), ("disposed", "disposition"), ("disposition", "disposition"), ("motion", "motion"),
    ("appearance", "appearance"), ("document", "filing"), ("filing", "filing"),
)


def index_number(text: Column) -> Column:
    """The first index number in a text without its spaces, or null."""
    return F.nullif(F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), INDEX_NUMBER, 1), r"\s+", ""), F.lit(""))


def event_kind(text: Column) -> Column:
    """Kind of an alert by the first of EVENT_WORDS in its text, else notification."""
    out, low = F.lit("notification"), F.lower(F.coalesce(text, F.lit("")))
    for word, kind in reversed(EVENT_WORDS):
        out = F.when(F.contains(low, F.lit(word)), kind).otherwise(out)
    return out


def labelled(body: Column) -> Column:
    """Map of the labelled lines of a text, label in lower case to value; the last of a label counts."""
    line = rf"(?im)^[ \t]*({'|'.join(LABELS)})[ \t]*[:\-][ \t]*(\S.*?)[ \t\r]*$"
    pair = lambda i: F.regexp_extract_all(body, F.lit(line), F.lit(i))
    pairs = F.reverse(F.arrays_zip(F.transform(pair(1), lambda x: F.lower(x)).alias("k"), pair(2).alias("v")))
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["k"]), p["k"]) == i + 1)
    return F.map_from_entries(first)


def _mail(content: bytes) -> list[tuple]:
    m = email.message_from_bytes(content, policy=email.policy.default)
    part = m.get_body(preferencelist=("plain", "html"))
    try:
        body = part.get_content() if part is not None else ""
    except (LookupError, UnicodeError):
        body = ""
    if part is not None and part.get_content_type() == "text/html":
        body = re.sub(r"<[^>]+>", " ", re.sub(r"(?i)</?(?:br|p|div|tr|li|h\d)\b[^>]*>", "\n", body))
    sender = str(m["From"] or "")
    return [(sender, str(m["Subject"] or ""), str(m["Message-ID"] or "").strip(), str(m["Date"] or ""), body)] if sender or body.strip() else []


def alerts(spool: DataFrame, trusted: tuple[str, ...], require_trusted: bool = True) -> DataFrame:
    """Mail of trusted senders (of all if not required) with its labelled fields, index number and event kind."""
    rows = _parsed(spool, _mail, "sender string, subject string, message_id string, sent string, body string")
    domain = F.lower(F.regexp_extract("sender", r"@([^>\s]+)", 1))
    safe = F.lit(False)
    for t in trusted:
        safe = safe | (domain == t) | F.endswith(domain, F.lit("." + t))
    rows = rows.withColumn("is_trusted", safe).withColumn("fields", labelled(F.col("body")))
    labels = [F.try_element_at("fields", F.lit(k)) for k in ("index number", "index no.", "index no")]
    index = F.coalesce(*[index_number(x) for x in (*labels, F.col("subject"), F.col("body"))])
    rows = rows.withColumn("event_kind", event_kind(F.concat_ws(" ", "subject", F.try_element_at("fields", F.lit("notification type")), "body")))
    return rows.withColumn("index_number", index).withColumn("natural_key", F.concat(F.coalesce("index_number", F.lit("")), F.lit(":"), F.coalesce(F.nullif("message_id", F.lit("")), F.substring("subject", 1, 80)))).where(F.col("is_trusted") | F.lit(not require_trusted))
