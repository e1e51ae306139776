"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionscore.landing import land


def components(edges: DataFrame) -> DataFrame:
    """`node, component` (the smallest node reachable) for every node in the edges `a, b` (bigint).

    Stars are widened and narrowed in turn: first each node's larger neighbours are tied to its smallest neighbour,
    then each node and its smaller ones. Every round is written and read again; rounds grow with the logarithm of
    the longest path. Loops and repeated edges are allowed; no edges give no rows. Hubs are split by Spark's
    handling of skewed joins, minima are taken within tasks first.
    """
    stars = land(edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = stars.union(stars.select("b", "a"))
        wide = _tied(both, both.filter("b > a"))
        narrow = land(_tied(wide, wide))
        now = narrow.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        stars, before = narrow, now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select("b", "b").distinct()).distinct()


def _tied(near: DataFrame, moved: DataFrame) -> DataFrame:
    """Ties each node's neighbours in `moved`, and the node itself, to the smallest of node and neighbours in `near`."""
    least = near.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    tied = moved.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.union(least).filter("a <> b").distinct()
