"""Documents to matters: keys of captions and dockets, groups, absorption of open-ended captions, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import collapse, strip
from .shared import written


def with_caption_key(rows: DataFrame, caption: Column, out: str) -> DataFrame:
    """rows with the comparison key of a caption; empty if it is too generic to be one.

    One column after another, so that every step is compiled and done once.
    """
    versus = r"(?iUs)^(.*?)\bv\.?\s(.*)$"
    made = ["__raw", "__right", "__us", "__key"]
    rows = rows.withColumn("__raw", strip(F.coalesce(caption, F.lit(""))))
    rows = rows.withColumn("__right", F.when(F.regexp_extract("__raw", versus, 1).rlike("(?iU)" + L.US_PLAINTIFF), F.regexp_extract("__raw", versus, 2)).otherwise(""))
    rows = rows.withColumn("__us", strip(F.col("__right")) != "")
    body = F.lower(F.when(F.col("__us"), F.col("__right")).otherwise(F.col("__raw")))
    body = F.replace(F.regexp_replace(body, r"\([^)]*\)", " "), F.lit("&"), F.lit(" and "))
    body = F.regexp_replace(body, r"[^a-z0-9 ]+", " ")
    body = collapse(F.regexp_replace(body, rf"\b(?:{'|'.join(L.CAPTION_NOISE)})\b", " "))
    rows = rows.withColumn("__key", body)
    rows = rows.withColumn("__key", F.when(F.col("__key") == "", "").otherwise(F.concat(F.when(F.col("__us"), "us v ").otherwise(""), F.col("__key"))))
    key = F.col("__key")
    useless = key.isin(*L.GENERIC_CAPTIONS) | (F.length(key) < L.MIN_KEY_CHARS) | (F.size(F.split(key, " ")) < L.MIN_KEY_TOKENS)
    return rows.withColumn(out, F.when(useless, "").otherwise(key)).drop(*made)


def with_docket_key(rows: DataFrame, docket: Column, out: str) -> DataFrame:
    """rows with yy-kind-number of a docket text without padding, or empty."""
    rows = rows.withColumn("__number", F.lower(F.regexp_extract(F.coalesce(docket, F.lit("")), "(?i)" + L.CASE_NUMBER, 1)))
    parts = [F.regexp_extract("__number", r"^(\d{2})-([a-z]{0,3})-?(\d+)$", i) for i in (1, 2, 3)]
    key = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), F.regexp_replace(parts[2], "^0+(?=[0-9])", ""))
    return rows.withColumn(out, F.when(F.col("__number") == "", "").otherwise(key)).drop("__number")


def open_ended(caption: Column) -> Column:
    return F.coalesce(caption, F.lit("")).rlike("(?iU)" + L.ET_AL)


def with_cluster_key(rows: DataFrame, out: str, caption: str = "case_caption", docket: str = "docket_number", uid: str = "item_uid") -> DataFrame:
    """rows with the caption's key, else the docket's, else the item's own."""
    rows = with_docket_key(with_caption_key(rows, F.col(caption), "__caption"), F.col(docket), "__docket")
    named = lambda kind, key: F.when(F.col(key) != "", F.concat(F.lit(kind), F.col(key)))
    own = F.concat(F.lit("uid:"), F.coalesce(uid, F.lit("")))  # never null, so that joins on keys need no test of the whole expression
    return rows.withColumn(out, F.coalesce(named("cap:", "__caption"), named("dkt:", "__docket"), own)).drop("__caption", "__docket")


def absorptions(keys: DataFrame) -> DataFrame:
    """short, target: open-ended caption keys that exactly one longer key extends at a token boundary.

    keys: cluster_key, all_open, of captions only. Every longer key names its own prefixes, so this is an equi-join on
    prefixes, one row for each token of a key. A key that is absorbed itself absorbs none: of a
    chain's links the one with the longest target stays.
    """
    keys = keys.select("cluster_key", "all_open")
    words = F.split("cluster_key", " ")
    prefixes = keys.select(F.col("cluster_key").alias("target"), F.explode(F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.array_join(F.slice(words, 1, i), " ")))).alias("short"))
    single = prefixes.join(keys.where("all_open").select(F.col("cluster_key").alias("short")), "short").groupBy("short").agg(F.count("*").alias("n"), F.max("target").alias("target")).where("n = 1").select("short", "target")
    chained = single.select(F.col("short").alias("target"))
    return single.join(chained, "target", "left_anti")


def with_matter(rows: DataFrame) -> DataFrame:
    """rows (item_uid, case_caption, docket_number, ...) with the cluster_key of their matter."""
    keyed = with_cluster_key(rows, "own_key")
    keys = keyed.groupBy(F.col("own_key").alias("cluster_key")).agg(F.bool_and(open_ended(F.col("case_caption"))).alias("all_open"), F.bool_or(F.col("own_key").startswith("cap:")).alias("named"))
    moved = absorptions(keys.where("named")).select(F.col("short").alias("own_key"), "target")
    return keyed.join(moved, "own_key", "left").withColumn("cluster_key", F.coalesce("target", "own_key")).drop("target", "own_key")


def heads(keyed: DataFrame) -> DataFrame:
    """Per matter of rows (cluster_key, item_uid, score, has_stated_damages, event_date): cluster_size, and item_uid and score of the row that stands for it.

    Rows are combined before the shuffle, so a hot matter is no hot task.
    """
    best = F.max(F.struct(F.round("score", 6).alias("s"), F.col("has_stated_damages").alias("d"), F.col("event_date").isNotNull().alias("e"), F.col("item_uid").alias("uid"), F.col("score").alias("score")))
    found = keyed.groupBy("cluster_key").agg(F.count("*").alias("cluster_size"), best.alias("best"))
    return found.select("cluster_key", "cluster_size", F.col("best.uid").alias("item_uid"), F.col("best.score").alias("score"))


def clustered(rows: DataFrame) -> DataFrame:
    """rows (item_uid, case_caption, docket_number, score, has_stated_damages, event_date) with cluster_key, cluster_size and is_primary."""
    keyed = with_matter(rows)
    first = heads(keyed).select("cluster_key", "cluster_size", F.col("item_uid").alias("primary_uid"))
    return keyed.join(first, "cluster_key").withColumn("is_primary", F.col("item_uid") == F.col("primary_uid")).drop("primary_uid")


#: Rows of the sample that the bounds of ranges are taken from, for each range.
SAMPLE = 100


def _bounds(heads: DataFrame, parts: int) -> list[tuple[float, str]]:
    """Places in the order of score and item_uid that cut heads into ranges of about equal size.

    They are chosen from about SAMPLE rows a range, picked by a hash; they only balance the ranges.
    """
    step = max(1, heads.count() // (SAMPLE * parts))
    picked = sorted((-r["score"], r["item_uid"]) for r in heads.where(F.pmod(F.xxhash64("item_uid"), F.lit(step)) == 0).select("score", "item_uid").where("score is not null and item_uid is not null").collect())
    return [picked[i * len(picked) // parts] for i in range(1, parts)] if len(picked) > parts else []


def _range(bounds: list[tuple[float, str]], low: int = 0) -> Column:
    """Number of bounds that are not after the row: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    score, uid = -bounds[mid][0], bounds[mid][1]
    before = (F.col("score") > score) | ((F.col("score") == score) & (F.col("item_uid") < uid))
    return F.when(before, _range(bounds[:mid], low)).otherwise(_range(bounds[mid + 1 :], low + mid + 1))


def ranked(rows: DataFrame) -> DataFrame:
    """rows with rank_in_run: primaries 1, 2, ... by score (null last) and item_uid, others null.

    Ranges of the order are numbered on their own and start after the rows of the ranges before, so no
    task sees all rows. The rows are written once, and ranges are dealt by bounds that are literals of
    the plan, so every use of them agrees whatever columns it reads.
    """
    rows, parts = written(rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = rows.where("is_primary")
    part = F.coalesce(_range(_bounds(heads, parts)), F.lit(parts))
    order = (F.desc_nulls_last("score"), F.asc("item_uid"))
    local = heads.withColumn("__part", part).withColumn("__place", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = heads.select(part.alias("__part")).groupBy("__part").agg(F.count("*").alias("n"))  # a row for each range
    before = sizes.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    numbered = local.join(F.broadcast(before), "__part").withColumn("rank_in_run", (F.col("__before") + F.col("__place")).cast("long")).drop("__part", "__place", "__before")
    return numbered.unionByName(rows.where("not coalesce(is_primary, false)").withColumn("rank_in_run", F.lit(None).cast("long")))
