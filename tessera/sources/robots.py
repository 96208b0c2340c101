"""What a robots.txt says of automated readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts of the names of AI crawlers.
AI_AGENTS = ("claudebot", "ccbot", "google-extended", "bytespider", "amazonbot", "gptbot", "anthropic-ai")


def ai_signals(files: DataFrame, agents: Sequence[str] = AI_AGENTS) -> DataFrame:
    """path and ai_signal of files (path, text): Content-Signal lines in order, then which AI crawlers are kept out; null if neither.

    A `Disallow: /` holds for all agents named before it, back to the last line of another kind than
    agents, allows, disallows and content signals. A file's lines are few, so windows over them are small.
    """
    line = F.trim(F.regexp_replace("line", "#.*$", ""))
    lines = files.select("path", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\r?\n")).alias("place", "line")).withColumn("line", line).where(F.contains("line", F.lit(":")))
    lines = lines.select("path", "place", F.lower(F.trim(F.split_part("line", F.lit(":"), F.lit(1)))).alias("field"), F.trim(F.regexp_replace("line", "^[^:]*:", "")).alias("value"))
    other = (~F.col("field").isin("user-agent", "disallow", "allow", "content-signal")).cast("int")
    lines = lines.withColumn("group", F.sum(other).over(Window.partitionBy("path").orderBy("place")))
    named = F.lit(False)
    for a in agents:
        named = named | F.contains(F.lower("value"), F.lit(a))
    shut = F.max(F.when((F.col("field") == "disallow") & (F.col("value") == "/"), F.col("place"))).over(Window.partitionBy("path", "group"))
    lines = lines.withColumn("blocked", (F.col("field") == "user-agent") & named & (F.col("place") < shut))
    told = lines.groupBy("path").agg(
        F.array_sort(F.collect_list(F.when(F.col("field") == "content-signal", F.struct("place", "value")))).alias("signals"),
        F.array_sort(F.collect_set(F.when(F.col("blocked"), F.lower("value")))).alias("agents"),
    )
    parts = F.concat(F.transform("signals", lambda x: F.concat(F.lit("Content-Signal: "), x["value"])), F.when(F.size("agents") > 0, F.array(F.concat(F.lit("blocks AI crawlers: "), F.array_join("agents", ", ")))).otherwise(F.array().cast("array<string>")))
    return files.select("path").join(told.select("path", F.when(F.size(parts) > 0, F.array_join(parts, "; ")).alias("ai_signal")), "path", "left")
