"""Connected components by alternating stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored


def _least(edges: DataFrame) -> DataFrame:
    """For every vertex ``u``, the least of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``links`` (``a, b``); the root is the least vertex reached.

    Large star: every vertex ties its greater neighbours to its least one.  Small star: it ties its
    smaller neighbours, and itself, to the least one.  Both keep the components; when a round
    changes nothing, every vertex points at its root.  The number of rounds grows with the
    logarithm of the longest path.  No links give no rows.
    """
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    down, before = stored(down, "stars"), None
    while True:
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        small = large.join(_least(large), "u")
        ends = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = ends.unionByName(small.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        down = stored(tied, "stars")
        # Any change moves an end to a smaller vertex or drops an edge, so count and sum decide.
        now = down.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = down.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    own = down.select(F.col("v").alias("vertex")).distinct()
    return stored(roots.unionByName(own.withColumn("root", F.col("vertex"))), "roots")
