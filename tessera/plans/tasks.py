"""Plans of work as rows, and lookups in small fixed dimensions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normal_name

#: Claims agents and the names that courts print for them.
AGENTS = {
    "epiq": ("epiq", "epiq corporate restructuring", "epiq bankruptcy solutions", "epiq systems"),
    "stretto": ("stretto", "bankruptcy management solutions"),
    "kroll": ("kroll", "kroll restructuring administration", "prime clerk", "ra kroll"),
    "verita": ("verita", "verita global", "kurtzman carson", "kurtzman carson consultants", "kcc"),
    "omni": ("omni", "omni agent solutions", "omni management group", "omni management"),
    "angeion": ("donlin", "donlin recano", "donlin, recano", "recano", "angeion"),
    "bmc": ("bmc", "bmc group"),
    "logan": ("logan", "logan & company", "logan and company"),
    "reliable": ("reliable", "reliable companies"),
    "american_legal": ("american legal", "american legal claim services"),
    "gcg": ("gcg", "garden city group"),
    "cpt": ("cpt", "cpt group"),
}


def load_agents(path: str) -> dict[str, tuple[str, ...]]:
    """Agents and their aliases from a TOML file of [[agent]] tables with id and aliases."""
    import tomllib

    with open(path, "rb") as file:
        return {a["id"]: tuple(a.get("aliases", ())) for a in tomllib.load(file)["agent"]}


def normal_text(name: str) -> str:
    """As functions.text.normal_name, of a constant."""
    return re.sub("[^a-z0-9]+", " ", name.lower().replace("&", " and ")).strip()


def day_query_form(spark: SparkSession, as_of: str, days: int, queries: Sequence[str], forms: Sequence[str] = (), anchor: bool = True) -> DataFrame:
    """A task for each day, form (if any are given) and query, and one anchor that must always find something."""
    day = F.explode(F.sequence(F.date_sub(F.lit(as_of).cast("date"), days - 1), F.lit(as_of).cast("date"))).alias("day")
    rows, parts = spark.range(1).select(day).withColumn("day", F.date_format("day", "yyyy-MM-dd")), ["day"]
    for name, values in (("form", forms), ("q", queries)):
        if values:
            rows, parts = rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values]))), [*parts, name]
    keyed = rows.select(F.concat_ws(":", *parts).alias("task_key"))
    return keyed.unionByName(spark.range(1).select(F.lit("anchor").alias("task_key"))) if anchor else keyed


def business_days(spark: SparkSession, as_of: str, days: int) -> DataFrame:
    """Weekdays of the last days with their quarter's index path."""
    day = F.explode(F.sequence(F.date_sub(F.lit(as_of).cast("date"), days - 1), F.lit(as_of).cast("date"))).alias("day")
    rows = spark.range(1).select(day).where(F.weekday("day") < 5)
    return rows.select("day", F.concat(F.lit("edgar/daily-index/"), F.year("day").cast("string"), F.lit("/QTR"), F.quarter("day").cast("string")).alias("path"))


def vendor(agent: Column, agents: Mapping[str, Sequence[str]] = AGENTS) -> Column:
    """Vendor of an agent's name: the longest alias it contains (ties: the first in order); none_retained if blank, else unmapped."""
    name = normal_name(agent)
    aliases = sorted(((normal_text(a), v) for v, names in agents.items() for a in names), key=lambda x: -len(x[0]))
    out = F.when(F.coalesce(name, F.lit("")) == "", "none_retained")
    for alias, v in aliases:
        out = out.when(F.contains(name, F.lit(alias)), v)
    return out.otherwise("unmapped")


def longest_suffix(host: Column, keys: Mapping[str, str], default: str) -> Column:
    """Value of the longest key that is the host or one of its parent domains."""
    out = F.lit(default)
    for suffix in sorted(keys, key=lambda s: (len(s), s)):
        out = F.when((host == suffix) | F.endswith(host, F.lit("." + suffix)), keys[suffix]).otherwise(out)
    return out


def coverage_confidence(has_rss: Column, entry_types: Column) -> Column:
    return F.when(has_rss.isNull(), "not_applicable").when(~has_rss, "low").when(F.coalesce(entry_types, F.lit("")).isin("all", "*"), "high").otherwise("partial")


def allowed(source_status: Column, purpose: Column, opted_in: Column, expired: Column) -> Column:
    """Why a source may not be read, or null if it may; an unknown source is unverified."""
    status = F.coalesce(source_status, F.lit("unverified"))
    return (
        F.when(status == "prohibited", "prohibited").when((status == "research_only") & (purpose != "research"), "research only")
        .when((status == "unverified") & ~F.coalesce(opted_in, F.lit(False)), "unverified").when(F.coalesce(expired, F.lit(False)), "review expired")
    )
