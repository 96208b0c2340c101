"""Text, date and money expressions over columns; all run in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rx(alternatives: Iterable[str]) -> str:
    """One pattern of alternatives, without regard to case, with Unicode classes as in other engines."""
    return "(?iU)" + "|".join(f"(?:{a})" for a in alternatives)


def found(col: Column, alternatives: Iterable[str], most: int = 6) -> Column:
    """The first matches in the text, stripped."""
    pattern = rx(alternatives)
    hits = F.transform(F.slice(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)), 1, most), lambda x: strip(x))
    return F.when(col.rlike(pattern), hits).otherwise(F.array().cast("array<string>"))  # most texts match nothing


def strip(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def collapse(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def lookup(col: Column, values: Mapping[str, Any], default: Any) -> Column:
    """Value of a small fixed map, or the default."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), col), F.lit(default))


def strip_html(col: Column) -> Column:
    """Tags become spaces, six entities characters, white space single."""
    out = F.regexp_replace(col, r"(?s)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse(out)


def readable(col: Column) -> Column:
    """Text of a page without scripts, styles, navigation, headers and footers."""
    return strip_html(F.regexp_replace(col, r"(?is)<(script|style|nav|header|footer)\b.*?</\1>", " "))


def escape_html(col: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(char), F.lit(entity))
    return col


def normal_name(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(col), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def moment(col: Column) -> Column:
    """ISO or RFC 822 text as a timestamp, null if it is neither."""
    plain = F.regexp_replace(col, "^[A-Za-z]+, *", "")
    return F.coalesce(F.try_to_timestamp(col), F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(col, F.lit("yyyyMMdd")))


def any_date(col: Column, formats: Iterable[str] = ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy")) -> Column:
    return F.to_date(F.coalesce(*[F.try_to_timestamp(strip(col), F.lit(f)) for f in formats]))


def money(col: Column) -> Column:
    """$1.2B, $340M, $12K or $950; empty if null or zero."""
    def figure(x: Column) -> Column:
        return F.replace(F.format_number(x, 0), F.lit(","), F.lit(""))

    return (
        F.when(col.isNull() | (col == 0), "")
        .when(col >= 1e9, F.concat(F.lit("$"), F.replace(F.concat(F.replace(F.format_number(col / 1e9, 1), F.lit(","), F.lit("")), F.lit("B")), F.lit(".0B"), F.lit("B"))))
        .when(col >= 1e6, F.concat(F.lit("$"), figure(col / 1e6), F.lit("M")))
        .when(col >= 1e3, F.concat(F.lit("$"), figure(col / 1e3), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), F.format_number(col, 0)))
    )


def item_uid(source_id: Column, natural_key: Column) -> Column:
    return F.sha2(F.concat(source_id, F.lit("\x00"), natural_key), 256)


def url_host(col: Column) -> Column:
    return F.lower(F.regexp_extract(col, "://([^/?#]*)", 1))


def title_case(col: Column) -> Column:
    """Every run of letters with its first one upper and the others lower, also after digits and signs."""
    return F.array_join(F.transform(F.regexp_extract_all(col, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def query_value(url: Column, name: str) -> Column:
    """A parameter of a url's query, decoded; empty if there is none, as it stands if it can't be decoded."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), rf"^[^#]*?[?&]{name}=([^&#]*)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)


def slug_title(col: Column) -> Column:
    """Last path segment with spaces for dashes; empty if it is a number or shorter than three characters."""
    path = F.regexp_replace(F.regexp_replace(col, "^[^:]*://[^/?#]*", ""), "[?#].*$", "")
    last = F.coalesce(F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1)), F.lit(""))
    words = F.replace(last, F.lit("-"), F.lit(" "))
    return F.when(words.rlike("^[0-9]+$") | (F.length(words) < 3), "").otherwise(title_case(words))
