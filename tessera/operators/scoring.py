"""The weighted score of an extraction, its parts, and the size band of its amount."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import let, lookup, strip


def _text(name: str, default: str) -> Column:
    return strip(F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default)))


def damages_norm(amount: Column) -> Column:
    """A dollar figure on a log scale, 0 at the floor and 1 at the ceiling."""
    return F.when(amount <= L.DAMAGES_FLOOR, 0.0).when(amount >= L.DAMAGES_CEILING, 1.0).otherwise((F.log10(amount) - 5) / 4)


def recency(moment: Column, as_of: Column) -> Column:
    """Halves every 30 days; a missing date is 0.3, a future one counts as today."""
    days = (F.unix_timestamp(as_of) - F.unix_timestamp(moment)) / 86400.0
    return F.when(moment.isNull(), 0.3).otherwise(F.pow(F.lit(0.5), F.greatest(F.lit(0.0), days) / L.HALF_LIFE_DAYS))


def collectability(is_public: Column, note: Column) -> Column:
    n = F.lower(F.coalesce(note, F.lit("")))
    any_of = lambda words: n.rlike("|".join(words))
    base = F.when(F.coalesce(is_public, F.lit(False)), 0.9).otherwise(0.5)
    base = F.when(any_of(L.INSOLVENCY), F.least(base, F.lit(0.25))).otherwise(base)
    return F.when(any_of(L.INSURANCE), F.greatest(base, F.lit(0.8))).otherwise(base)


def venue_match(*parts: Column) -> Column:
    """quality and needle of the best venue named in the parts: above 0.5, the first of equals; else the default."""
    needles = F.array(*[F.struct(F.lit(q).alias("quality"), F.lit(-i).alias("place"), F.lit(n).alias("needle")) for i, (n, q) in enumerate(L.VENUE_QUALITY.items())])
    default = F.struct(F.lit(0.5).alias("quality"), F.lit(0).alias("place"), F.lit("default").alias("needle"))
    blob = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    return let(blob, lambda b: F.coalesce(F.array_max(F.filter(needles, lambda n: F.contains(b, n["needle"]) & (n["quality"] > 0.5))), default))


def size_band(amount: Column, imputed: Column) -> Column:
    out = F.lit(L.SIZE_BANDS[-1][0])
    for label, low, high in reversed(L.SIZE_BANDS[:-1]):
        out = F.when((amount >= low) & (amount < high), label).otherwise(out)
    return F.when(imputed | amount.isNull() | (amount <= 0), L.NOT_STATED).otherwise(out)


def scored(rows: DataFrame, as_of: str, weights: Mapping[str, float] | None = None, event_fit: Mapping[str, float] | None = None) -> DataFrame:
    """rows with components (a struct), damages_imputed and score.

    rows: deal_thesis, event_type, damages_usd, damages_conf, event_date, published_at (timestamps), is_public,
    collectability_note, venue, court, jurisdiction, practice_area, practice_conf, source_confidence.
    """
    w, fit = {**L.WEIGHTS, **(weights or {})}, {**L.EVENT_FIT, **(event_fit or {})}
    thesis, amount = _text("deal_thesis", "none"), F.col("damages_usd")
    stated = F.coalesce(amount > 0, F.lit(False))
    prior = damages_norm(lookup(thesis, L.THESIS_PRIORS, L.THESIS_PRIORS["none"])) * L.IMPUTED_DISCOUNT
    parts = {
        "thesis_fit": lookup(_text("event_type", "no_event"), fit, 0.2) * lookup(thesis, L.THESIS_PRIORITY, 0.0),
        "damages": F.when(stated, damages_norm(amount) * lookup(_text("damages_conf", "none"), L.CONFIDENCE, 0.5)).otherwise(prior),
        "recency": recency(F.coalesce(F.col("event_date"), F.col("published_at")), F.lit(as_of).cast("timestamp")),
        "collectability": collectability(F.col("is_public"), F.col("collectability_note")),
        "venue": venue_match(F.col("venue"), F.col("court"), F.col("jurisdiction"))["quality"],
        "practice_fit": lookup(_text("practice_area", "unknown"), L.PRACTICE_FIT, 0.25) * lookup(_text("practice_conf", "medium"), L.CONFIDENCE, 0.75),
        "source_confidence": F.coalesce(F.col("source_confidence"), F.lit(0.8)),
    }
    out = rows.withColumn("components", F.struct(*[v.cast("double").alias(k) for k, v in parts.items()])).withColumn("damages_imputed", ~stated)
    total = F.lit(0.0)
    for name in parts:
        total = total + F.lit(w[name]) * F.col(f"components.{name}")
    return out.withColumn("score", F.round(total, 6))
