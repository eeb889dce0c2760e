"""Connected components of a link table, by rounds of large-star and small-star contraction.

Each round is a handful of aggregates and joins; the number of rounds grows with the logarithm of
the longest path.  No component, neighbour list or link table is gathered anywhere: a hub with
millions of links is a key of partial aggregates and of joins that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``links`` (a, b) of one orderable type, either order, repeats allowed; rows with a null or
    a = b link nothing.  Returns (node, root) for every linked node but the roots themselves; root is
    the smallest node that can be reached.  An empty table gives an empty table.
    """
    edges = (links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint())
    state = None
    for _ in range(max_rounds):
        # large star: every neighbour above u moves to the smallest neighbour of u
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: every neighbour below u, and u, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = small.where("u <> v").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
