"""Verdicts on runs, staleness of sources, budgets, rate windows and breakers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L


def verdict(rows_parsed: Column, rows_new: Column, not_modified: Column, has_body: Column, server_empty: Column) -> Column:
    """verdict and note of a run: no rows from a body is a broken parser, unless the server said there are none."""
    told = lambda v, note: F.struct(F.lit(v).alias("verdict"), note.alias("note"))
    return (
        F.when(not_modified & ~has_body, told("HEALTHY", F.lit("nothing to parse")))
        .when((rows_parsed == 0) & server_empty, told("HEALTHY", F.lit("the server reports no rows")))
        .when((rows_parsed == 0) & not_modified, told("BROKEN", F.lit("no rows in a cached body")))
        .when(rows_parsed == 0, told("BROKEN", F.lit("no rows in a new body")))
        .when(rows_new == 0, told("HEALTHY", F.concat(F.lit("parsed "), rows_parsed.cast("string"), F.lit(", none new"))))
        .otherwise(told("HEALTHY", F.concat(F.lit("parsed "), rows_parsed.cast("string"), F.lit(", "), rows_new.cast("string"), F.lit(" new"))))
    )


def latest(health: DataFrame, n: int = L.HISTORY_ROWS) -> DataFrame:
    w = Window.partitionBy("source_id").orderBy(F.desc("observed_at"), F.desc("run_id"))
    return health.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)


def staleness(health: DataFrame, as_of: str) -> DataFrame:
    """Per source with enough history: typical and worst gap in hours, hours since the last new rows, is_stale."""
    recent = latest(health)
    enough = recent.groupBy("source_id").agg(F.count("*").alias("n")).where(F.col("n") >= L.MIN_HISTORY).select("source_id")
    productive = recent.where("rows_new > 0").join(enough, "source_id", "left_semi")
    gap = (F.unix_timestamp("observed_at") - F.lag(F.unix_timestamp("observed_at")).over(Window.partitionBy("source_id").orderBy("observed_at", "run_id"))) / 3600.0
    stats = productive.withColumn("gap", gap).groupBy("source_id").agg(F.count("*").alias("productive"), F.median("gap").alias("typical"), F.max("gap").alias("worst"), F.max("observed_at").alias("last"))
    since = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last")) / 3600.0
    out = stats.where(F.col("productive") >= L.MIN_PRODUCTIVE).withColumn("since", since)
    return out.select("source_id", F.col("productive"), F.round("typical", 6).alias("typical_h"), F.round("worst", 6).alias("worst_h"), F.round("since", 6).alias("since_h"), (F.col("since") > F.greatest(F.col("worst"), F.col("typical") * L.TOLERANCE)).alias("is_stale"))


def trailing_failures(runs: DataFrame) -> DataFrame:
    """Failures of each source since its last success. runs: source_id, seq, failed."""
    last = runs.groupBy("source_id").agg(F.max(F.when(~F.col("failed"), F.col("seq"))).alias("last_ok"), F.count("*").alias("runs"))
    after = runs.join(last, "source_id").groupBy("source_id").agg(F.count_if(F.col("failed") & (F.col("last_ok").isNull() | (F.col("seq") > F.col("last_ok")))).alias("consecutive_failures"), F.max("runs").alias("runs"))
    return after


def budget(requests: DataFrame, cap: int, warn: float = L.WARN_SHARE) -> DataFrame:
    """Per day: asked, granted within the cap, remaining, and the request that first reached the warning share."""
    place = F.row_number().over(Window.partitionBy("day").orderBy("seq"))
    counted = requests.withColumn("place", place)
    return counted.groupBy("day").agg(F.count("*").alias("asked"), F.least(F.count("*"), F.lit(cap)).alias("granted"), F.greatest(F.lit(0), F.lit(cap) - F.count("*")).alias("remaining"), F.min(F.when(F.col("place") >= warn * cap, F.col("seq"))).alias("warned_at"))


def sliding_counts(events: DataFrame, seconds: int, most: int) -> DataFrame:
    """events with the number of the key's events in the last seconds, and whether that exceeds most."""
    w = Window.partitionBy("key").orderBy(F.unix_timestamp("ts")).rangeBetween(-seconds, 0)
    return events.withColumn("recent", F.count("*").over(w)).withColumn("locked", F.col("recent") > most)


def token_bucket(requests: DataFrame, rps: float, burst: float) -> DataFrame:
    """Which requests (key, seq, at in seconds) a token bucket lets through; one pass in order, a key's state alone is kept."""
    ordered = requests.select("key", "seq", F.col("at").cast("double").alias("at")).repartition("key").sortWithinPartitions("key", "at", "seq")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, tokens, last = None, burst, 0.0
        for batch in batches:
            passed = []
            for k, at in zip(batch["key"], batch["at"], strict=True):
                if k != key:
                    key, tokens, last = k, burst, at
                tokens = min(burst, tokens + (at - last) * rps)
                last = at
                passed.append(tokens >= 1)
                tokens -= passed[-1]
            yield batch.assign(passed=passed)

    return ordered.mapInPandas(rows, "key long, seq long, at double, passed boolean")


def breaker(calls: DataFrame, failures: int = 5, rest: float = 1800.0) -> DataFrame:
    """State of a circuit breaker before each call (key, seq, at, failed): closed, open (the call is not made) or half_open."""
    ordered = calls.select("key", "seq", F.col("at").cast("double").alias("at"), "failed").repartition("key").sortWithinPartitions("key", "at", "seq")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, bad, opened = None, 0, None
        for batch in batches:
            states = []
            for k, at, failed in zip(batch["key"], batch["at"], batch["failed"], strict=True):
                if k != key:
                    key, bad, opened = k, 0, None
                state = "closed" if opened is None else "open" if at - opened < rest else "half_open"
                states.append(state)
                if state == "open":
                    continue
                bad = bad + 1 if failed else 0
                opened = at if failed and (state == "half_open" or bad >= failures) else None
            yield batch.assign(state=states)

    return ordered.mapInPandas(rows, "key long, seq long, at double, failed boolean, state string")
