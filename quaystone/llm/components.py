"""Connected components of an edge table by alternating star contractions (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _to_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v): joined to the least neighbour of u (or u itself) as m.

    The minima are written first, so that the join has shuffles of its own: a hub
    with a large share of all edges is then split over tasks.
    """
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): every node of an edge with the least node it can reach.

    Nodes may be of any orderable type. Each round is a grouped minimum (partly
    aggregated before the shuffle) and a join; every round ends in a written
    table. The number of rounds grows with the logarithm of the nodes.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("v"), F.col("u")))
        large = (_to_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        joined = _to_minimum(large)
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = stage(small)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stage(now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots))
