"""Connected components by alternating large-star and small-star rounds.

Links stay distributed from start to end: each round rewires every node to the least
neighbour it knows, and after a few rounds (their number grows with the logarithm of
the longest path) each component is a star about its least member. Rounds are written
to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, written


def components(links: DataFrame, *, rounds: int = 40) -> DataFrame:
    """Links (a, b) to (id, component): the least id that can be reached, for every id
    that is not the least of its component. Loops and nulls are left out. Ids may be of any
    type that has an order."""
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    for _ in range(rounds):
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = spread_join(both.where("v > u"), least, ["u"], "v").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, ["u"], "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a lesser one, or some from larger ones, but not both."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down + up > 1").isEmpty()
