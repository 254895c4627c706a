"""Connected components of an edge table, by alternating star joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import dropped, saved


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of the undirected edges (``u``, ``v``).

    Each round joins every node to the smallest node of its star, first over larger neighbours and then over
    smaller ones; rounds grow with the logarithm of the longest chain. No star is gathered: each round is a minimum
    by key (pre-aggregated) and a join (split by adaptive execution when a star is large). The edges of a round, each
    from its larger node, and each node's smallest neighbour are written to the shared folder, so a lost executor costs
    one round. It is over when every node with a smaller neighbour has no other: then all that is left are stars around
    their smallest node. Self-loops, repeated and null edges are fine.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    stars = _stars(now)
    while not stars.where("m < u and m < last").isEmpty():
        least = stars.select("u", F.least("u", "m").alias("m"))
        large = now.join(least.toDF("v", "m"), "v").select("u", F.col("m").alias("v"))
        # Every edge now leads to a smaller node.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        dropped(now)
        dropped(stars)
        now, stars = after, _stars(after)
    dropped(now)
    return stars.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))


def _stars(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with its smallest and its ``last`` neighbour (``m``, ``last``)."""
    ends = F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return saved(edges.select(F.inline(ends)).groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("last")), "stars")
