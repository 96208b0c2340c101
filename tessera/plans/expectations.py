"""What a collected artifact must look like before it is parsed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """content_types empty: any; sizes 0: no bound; markers and anchors must all be in the body."""

    content_types: Sequence[str] = ()
    min_bytes: int = 0
    max_bytes: int = 0
    markers: Sequence[str] = ()
    anchors: Sequence[str] = ()


_FEED = Expectation(("application/rss+xml", "text/xml", "application/xml"), 500, markers=("<item",))
#: Expectations by source.
EXPECTATIONS = {
    "sec_litrel": _FEED,
    "doj_atr": _FEED,
    "ftc": _FEED,
    "sec_fts": Expectation(("application/json",), 20, markers=('"hits"',)),
    "courtlistener": Expectation(("application/json",), 20, markers=('"results"',)),
    "edgar_index": Expectation((), 1000, markers=("Form Type",)),
    "govinfo": Expectation(("application/json",), 20, markers=('"packages"',)),
    "doj_atr_case_filings": Expectation(("text/html",), 50_000, markers=("views-row",)),
    "jpml": Expectation(("text/html",), 5_000),
    "jpml_pdf": Expectation((), 2_000),
    "state_ag": Expectation((), 200),
    "claims_routing": Expectation(("text/html",), 2_000),
    "claims_stretto": Expectation((), 500),
}
#: Extension of a content type's files.
EXTENSIONS = {
    "application/rss+xml": "xml", "application/atom+xml": "xml", "application/xml": "xml", "text/xml": "xml", "application/json": "json", "text/html": "html",
    "text/plain": "txt", "application/pdf": "pdf", "message/rfc822": "eml",
}
_SUFFIXES = ("pdf", "json", "xml", "html", "txt")


def dimension(frame: DataFrame, expectations: Mapping[str, Expectation] = EXPECTATIONS) -> DataFrame:
    """The expectations as rows, in frame's session."""
    rows = [(k, list(e.content_types), e.min_bytes, e.max_bytes, list(e.markers), list(e.anchors)) for k, e in expectations.items()]
    return frame.sparkSession.createDataFrame(rows, "source_id string, content_types array<string>, min_bytes long, max_bytes long, markers array<string>, anchors array<string>")


def checked(artifacts: DataFrame, expectations: Mapping[str, Expectation] = EXPECTATIONS) -> DataFrame:
    """artifacts (source_id, content, content_type, ...) with `failure`: the first expectation that isn't met, or null.

    A source without expectations meets them; null content is an empty body and a null type is ''.
    """
    body = F.make_valid_utf8(F.coalesce(F.col("content"), F.lit(b"")).cast("string"))
    joined = artifacts.join(F.broadcast(dimension(artifacts, expectations)), "source_id", "left")  # a row for each source
    joined = joined.withColumns({"__text": body, "__size": F.coalesce(F.octet_length("content"), F.lit(0)), "__kind": F.coalesce("content_type", F.lit(""))})
    absent = lambda needles: F.get(F.filter(needles, lambda n: ~F.contains(F.col("__text"), n)), F.lit(0))
    failure = (
        F.when((F.size("content_types") > 0) & ~F.array_contains("content_types", F.col("__kind")), F.concat(F.lit("content type "), "__kind"))
        .when((F.col("min_bytes") > 0) & (F.col("__size") < F.col("min_bytes")), F.concat(F.lit("too short: "), F.col("__size").cast("string")))
        .when((F.col("max_bytes") > 0) & (F.col("__size") > F.col("max_bytes")), F.concat(F.lit("too long: "), F.col("__size").cast("string")))
        .when(absent(F.col("markers")).isNotNull(), F.concat(F.lit("no marker "), absent(F.col("markers"))))
        .when(absent(F.col("anchors")).isNotNull(), F.concat(F.lit("no anchor "), absent(F.col("anchors"))))
    )
    return joined.withColumn("failure", failure).select(*artifacts.columns, "failure")


def has_index_header(text: Column, header: str = "Form Type", lines: int = 60) -> Column:
    """Whether one of the first lines names the index's columns."""
    return F.exists(F.slice(F.split(text, "\r?\n"), 1, lines), lambda x: F.contains(x, F.lit(header)))


def is_placeholder(contact: Column, placeholders: Sequence[str]) -> Column:
    """Whether a contact address is one of the samples that nobody has replaced, or blank."""
    return F.lower(F.trim(F.coalesce(contact, F.lit("")))).isin("", *[p.lower() for p in placeholders])


def extension(content_type: Column, url: Column) -> Column:
    """Extension of an artifact's file: that of its type, else the url's, else bin."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    out = F.lit("bin")
    for x in reversed(_SUFFIXES):
        out = F.when(F.endswith(F.lower(F.coalesce(url, F.lit(""))), F.lit("." + x)), x).otherwise(out)
    for k, x in EXTENSIONS.items():
        out = F.when(kind == k, x).otherwise(out)
    return out
