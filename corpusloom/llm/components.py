"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise


def _settled(edges: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    done = materialise(edges.distinct(), name)
    n, total = done.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return done, n, total


def components(edges: DataFrame) -> DataFrame:
    """(u, root): every node of an edge and the smallest node of its component.

    edges: (u, v), any direction, repeats allowed. Rounds of large-star and small-star: each node sends
    its larger, then its smaller neighbours to the smallest one, until nothing changes. The number of
    rounds grows with the logarithm of the nodes. Every round is a table in the shared folder.
    """
    now, n, total = _settled(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges"
    )
    while True:
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "large-star")
        # Small star: neighbours below a node, and the node, go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        new, n_new, total_new = _settled(small.union(own).filter("u <> v"), "small-star")
        if (n, total) == (n_new, total_new):
            roots = new.select("v").distinct()
            return new.select("u", F.col("v").alias("root")).union(roots.select("v", "v"))
        now, n, total = new, n_new, total_new
