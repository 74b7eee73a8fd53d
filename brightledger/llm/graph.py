"""Connected components by alternating large-star and small-star steps, as joins over staged edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node with a link, and the smallest node reachable from it.

    Nulls and self links are ignored. Each step hangs neighbours under a smaller node, so chains fold up in a number of
    rounds that grows with the logarithm of their length. Minima are aggregated on the map side and staged; a hub's links
    meet its one minimum in a plain join, which adaptive execution splits.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    pairs, before = stage(pairs.distinct()), None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
        before = mark
        # large star: the larger neighbours of each node move to its smallest neighbour
        ends = pairs.select(F.col("hi").alias("at"), F.col("lo").alias("to")).unionByName(pairs.select(F.col("lo").alias("at"), F.col("hi").alias("to")))
        least = stage(ends.groupBy("at").agg(F.min("to").alias("to")).select("at", F.least("at", "to").alias("least")))
        pairs = pairs.join(least, pairs.lo == least["at"]).select("hi", F.col("least").alias("lo")).where("hi <> lo")
        pairs = stage(pairs.distinct())
        # small star: the smaller neighbours of each node, and the node itself, move to the smallest of them
        least = pairs.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
        moved = pairs.join(least, pairs.hi == least["at"]).select("lo", F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("least").alias("to")), F.struct(F.col("hi"), F.col("least").alias("to")))).alias("x"))
        pairs = stage(moved.select("x.hi", F.col("x.to").alias("lo")).where("hi <> lo").distinct())
