"""Connected components of an edge table, by alternating large and small stars.

Every round replaces edges by edges to the smallest neighbour, so paths shorten by about
half per round. The smallest neighbour of each node is a partial and final aggregate that
is joined back; a node with very many neighbours is therefore never gathered. Each round is
checkpointed in the shared folder. Null ends and self loops are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node with an edge."""
    now = edges.select("u", "v").where("u <> v").distinct().checkpoint()
    state = None
    while True:
        after = _star(_star(now, large=True), large=False).checkpoint()
        # Equal sets of edges have equal counts and equal sums of hashes.
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        now, state = after, mark
    found = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
