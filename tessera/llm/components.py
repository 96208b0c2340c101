"""Connected components of links by alternating stars; nodes may be of any type that orders.

Links with a null end, from a node to itself, or repeated add nothing; without links there are no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dropped


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, comp) of every linked node; comp is the component's least node. links: a, b.

    Each round hangs every node on its least neighbour (large star, then small star) and is written to
    the shared folder; the number of rounds grows with the logarithm of the nodes.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before, k = checkpointed(edges, folder, f"{name}-0"), None, 0
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        before, k = mark, k + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.distinct(), folder, f"{name}-{k}")
        dropped(links.sparkSession, folder, f"{name}-{k - 1}")
