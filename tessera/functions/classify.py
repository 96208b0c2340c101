"""Ordered lexical classifiers: event, practice area, exclusion, stage, jurisdiction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as L
from .text import collapse, found, lookup, rx, strip


def _any(col: Column, alternatives: tuple[str, ...]) -> Column:
    return col.rlike(rx(alternatives))


EVENT_FAMILIES = {
    "proposed": L.PROPOSED_JUDGMENT, "outcome": L.VERDICT, "form": L.PROPOSED_VERDICT, "entered": L.JUDGMENT_ENTERED, "appeal": L.APPEAL,
    "approved": L.SETTLEMENT_APPROVED, "settled": L.SETTLEMENT_REACHED, "antitrust": L.ANTITRUST,
}


def with_event(rows: DataFrame, text: Column, prefix: str = "", matched: bool = False) -> DataFrame:
    """rows with thesis, event_class and strength of a text, and matched if asked: the first rule that fits decides.

    Each family is looked for once, in a projection of its own.
    """
    t = F.coalesce(text, F.lit(""))
    rows = rows.withColumns({f"__{k}": _any(t, family) for k, family in EVENT_FAMILIES.items()})
    proposed, entered, appeal, approved, settled, antitrust = (F.col(f"__{k}") for k in ("proposed", "entered", "appeal", "approved", "settled", "antitrust"))
    verdict = F.col("__outcome") & ~F.col("__form")  # a proposed verdict form is no outcome
    open_thesis, judgment = F.when(antitrust, "antitrust_followon").otherwise("post_settlement"), F.lit("judgment_monetization")
    rules = [
        (proposed, open_thesis, "settlement_proposed", F.when(antitrust, 0.85).otherwise(0.7), (L.PROPOSED_JUDGMENT,)),
        (verdict, judgment, "verdict", F.lit(0.9), (L.VERDICT,)),
        (entered & appeal, judgment, "appeal", F.lit(0.95), (L.JUDGMENT_ENTERED, L.APPEAL)),
        (entered, judgment, "judgment_entered", F.lit(0.8), (L.JUDGMENT_ENTERED,)),
        (appeal, judgment, "appeal", F.lit(0.6), (L.APPEAL,)),
        (approved, F.lit("post_settlement"), "settlement_approved", F.lit(0.8), (L.SETTLEMENT_APPROVED,)),
        (settled, open_thesis, "settlement_reached", F.when(antitrust, 0.85).otherwise(0.75), (L.SETTLEMENT_REACHED,)),
        (antitrust, F.lit("antitrust_followon"), "enforcement", F.lit(0.4), (L.ANTITRUST,)),
    ]
    out = {"thesis": F.lit("none"), "event_class": F.lit("other"), "strength": F.lit(0.0), "matched": F.array().cast("array<string>")}
    for fits, thesis, kind, strength, families in reversed(rules):
        told = {"thesis": thesis, "event_class": F.lit(kind), "strength": strength}
        if matched:
            told["matched"] = F.concat(*[found(t, f) for f in families])
        out = out | {k: F.when(fits, v).otherwise(out[k]) for k, v in told.items()}
    if not matched:
        del out["matched"]
    return rows.withColumns({prefix + k: v for k, v in out.items()}).drop(*[f"__{k}" for k in EVENT_FAMILIES])


def practice_hints(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(_any(text, family), name) for name, family in (("antitrust", L.ANTITRUST), ("bankruptcy", L.BANKRUPTCY), ("commercial", L.COMMERCIAL))]))


FORFEITURE_REASON = "government asset forfeiture -- no assignable claim and no counterparty to collect from; any dollar figure is the SEIZED amount, not a claim"
CARVEOUT_REASON = "criminal signals present but antitrust carve-out applies -- criminal antitrust leads to follow-on civil damages"


AREA_FAMILIES = {"intellectual_property": L.IP, "international_arbitration": L.INTL_ARB, "consumer": L.CONSUMER, "forfeiture": L.FORFEITURE}


def with_exclusion(rows: DataFrame, text: Column, prefix: str = "", reasons: bool = False) -> DataFrame:
    """rows with excluded and area of a text, and matched and reason if asked: areas in order, then criminal unless antitrust carves it out."""
    t = F.coalesce(text, F.lit(""))
    families = {**AREA_FAMILIES, "criminal": L.CRIMINAL, "carveout": L.CRIMINAL_CARVEOUT}
    rows = rows.withColumns({f"__{k}": _any(t, family) for k, family in families.items()})
    criminal, carved = F.col("__criminal"), F.col("__carveout")
    shown = lambda why, hits: F.concat(F.lit(f"{why}: "), F.array_join(F.slice(hits, 1, 3), ", "))
    hits = {k: found(t, family) for k, family in families.items()} if reasons else {}
    out = {"area": F.when(criminal & ~carved, "criminal").otherwise("none")}
    if reasons:
        out["matched"] = F.when(criminal, hits["criminal"]).otherwise(F.array().cast("array<string>"))
        out["reason"] = F.when(criminal & carved, CARVEOUT_REASON).when(criminal, shown("criminal prosecution -- no damages award to monetize", hits["criminal"])).otherwise("")
    for name in reversed(AREA_FAMILIES):
        fits = F.col(f"__{name}")
        out["area"] = F.when(fits, name).otherwise(out["area"])
        if reasons:
            why = FORFEITURE_REASON if name == "forfeiture" else f"lexical screen matched {name} terms"
            out |= {"matched": F.when(fits, hits[name]).otherwise(out["matched"]), "reason": F.when(fits, shown(why, hits[name])).otherwise(out["reason"])}
    rows = rows.withColumns({prefix + k: v for k, v in out.items()}).drop(*[f"__{k}" for k in families])
    return rows.withColumn(prefix + "excluded", F.col(prefix + "area") != "none")


def audit_line(excluded: Column, area: Column, matched: Column) -> Column:
    return F.when(~excluded, "kept").otherwise(F.concat(F.lit("excluded["), area, F.lit("] on "), F.array_join(F.slice(matched, 1, 3), ", ")))


def stage(posture: Column, event_type: Column) -> Column:
    """stage and basis: the posture's first matching group, else the event's stage, else unclear."""
    p, e = strip(F.coalesce(posture, F.lit(""))), strip(F.coalesce(event_type, F.lit("")))
    told = lambda label, basis: F.struct(label.alias("stage"), F.lit(basis).alias("basis"))
    of_event = lookup(e, L.STAGE_OF_EVENT, None)
    out = F.when(of_event.isNotNull(), told(of_event, "event type")).otherwise(told(F.lit(L.STAGE_UNKNOWN), ""))
    for label, patterns in reversed(L.STAGES):
        out = F.when((p != "") & p.rlike(rx(patterns)), told(F.lit(label), "posture")).otherwise(out)
    return out


def jurisdiction(jurisdiction: Column, venue: Column, court: Column) -> Column:
    """group and label of a court's text."""
    blob = F.trim(F.lower(F.concat_ws(" ", *[F.coalesce(x, F.lit("")) for x in (jurisdiction, venue, court)])))
    names = F.array(*[F.lit(s) for s in L.STATES])
    named = F.try_element_at(F.filter(names, lambda n: F.contains(blob, F.lower(n))), F.lit(1))
    flat = collapse(F.replace(blob, F.lit("."), F.lit("")))
    short = [lookup(F.regexp_extract(flat, pattern, 1), L.ABBREVIATIONS, None) for pattern in (r"\b[nsewmc]?d([a-z]{2,4})\b", r"\b[nsewmc]?d\s+([a-z]{2,5})\b")]
    state = F.coalesce(named, *short)

    def hinted(hints: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for h in hints:
            out = out | F.contains(blob, F.lit(h))
        return out

    federal, local = hinted(L.FEDERAL_HINTS), hinted(L.STATE_HINTS) | (F.lower(F.trim(F.coalesce(jurisdiction, F.lit("")))) == "state")
    dash = lambda word: F.when(state.isNotNull(), F.concat(F.lit(f"{word} — "), state)).otherwise(word)
    group = F.when(blob == "", "Unknown").when(federal, "Federal").when(local, "State").otherwise("Unknown")
    label = F.when(blob == "", "Unknown").when(federal, dash("Federal")).when(local, dash("State")).when(state.isNotNull(), F.concat(state, F.lit(" (court unclear)"))).otherwise("Unknown")
    return F.struct(group.alias("group"), label.alias("label"))


# --- Fixed values: sentences of a row's description ----------------------------------------------
EVENT_PHRASE = {
    "judgment_entered": "A court entered judgment", "judgment_proposed": "A proposed judgment was filed (not yet entered)", "jury_verdict": "A jury returned a verdict",
    "appeal_filed": "An appeal was filed", "settlement_reached": "The parties reached a settlement", "settlement_preliminary_approval": "A settlement got preliminary approval",
    "settlement_final_approval": "A settlement was finally approved", "enforcement_action": "A regulator brought an enforcement action",
    "plan_confirmation": "A bankruptcy plan was confirmed", "case_filed": "A case was filed", "no_event": "No decided event yet",
}
THESIS_PHRASE = {
    "judgment_monetization": "could support judgment or appeal funding", "post_settlement": "could support a settlement-receivable purchase",
    "antitrust_followon": "could lead to follow-on antitrust damages", "none": "no clear funding angle",
}
AREA_PHRASE = {"antitrust": "antitrust", "commercial": "commercial", "bankruptcy": "bankruptcy", "securities": "securities", "other": "", "unknown": ""}


def description(event_type: Column, thesis: Column, area: Column, place: Column, amount_text: Column, is_public: Column) -> Column:
    """One sentence of what a row is; total, so every row has one."""
    kind = lookup(area, AREA_PHRASE, "")
    article = F.when(kind.rlike("^[aeiou]"), "an ").otherwise("a ")
    where = F.coalesce(strip(place), F.lit(""))
    said = lookup(thesis, THESIS_PHRASE, "")
    return F.concat(
        lookup(event_type, EVENT_PHRASE, "Something happened"),
        F.when(kind != "", F.concat(F.lit(" in "), article, kind, F.lit(" matter"))).otherwise(""),
        F.when(where != "", F.concat(F.lit(" in "), where)).otherwise(""),
        F.lit("."),
        F.when(F.coalesce(amount_text, F.lit("")) != "", F.concat(F.lit(" Stated amount "), amount_text, F.lit("."))).otherwise(" No amount stated."),
        F.when(said != "", F.concat(F.when(thesis != "none", " It ").otherwise(" Currently "), said, F.lit("."))).otherwise(""),
        F.when(F.coalesce(is_public, F.lit(False)), " Defendant is a public company.").otherwise(""),
    )
