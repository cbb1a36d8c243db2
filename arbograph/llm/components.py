"""Connected components of an edge table by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .batches import saved


def connected_components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """edges(a long, b long), undirected -> (node, component): every node with an edge and the smallest node it reaches.

    Each step is a groupBy-min and a join on the node, so a hub's neighbours are never gathered in one task. Rounds
    grow with the logarithm of the longest path; each is written to the shared folder. Self loops and repeated edges
    are harmless, an empty table gives an empty result, rows with a null end are ignored.
    """
    spark = edges.sparkSession
    edges = saved(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = saved(small.where("a <> b").distinct(), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(pairs.select(F.col("component").alias("node"), "component").distinct())
