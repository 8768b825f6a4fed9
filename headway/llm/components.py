"""Connected components by alternating large and small stars, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, hot_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links between integer nodes -> (node, component), component being the least node that can be reached.

    Only nodes with a link to another node come back. Self links, repeated links and links with a null don't count; no links
    give no rows. Every round is checkpointed, minima are pre-aggregated, and a hub's links stay where they are (hot_join), so
    they never meet in one task.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links, seen = checkpointed(links.distinct()), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).union(links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = checkpointed(both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"), F.count("*").alias("n")))
        large = checkpointed(hot_join(both, least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = hot_join(large, least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
