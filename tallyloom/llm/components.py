"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link with the least node reachable from it.

    Each round is a join with per-node minima (partial aggregates, so a node
    with very many links is combined before the shuffle) and is stored; the
    number of rounds grows with the logarithm of the longest chain.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: greater neighbours go to the least of the neighbourhood
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: the node and its smaller neighbours go to the least of them
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        new = stored(small, "star")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return out.unionByName(roots)
