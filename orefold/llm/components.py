"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import materialise


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of its component.

    Large-star and small-star rounds alternate: a node's greater neighbours, then its smaller ones, are
    linked to the smallest node it knows. The tree of every component becomes a star after a number of
    rounds that grows with the logarithm of its size. Each round is a written table, so no lineage builds
    up. A node with very many links is only met as the key of sums (one row for each task) and of joins,
    whose large partitions Spark splits. Null ends and self-links count as no link.
    """
    edges = materialise(links.where("a <> b").select("a", "b"), "links")
    before = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        star = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        star = star.distinct()  # a > b from here on
        low = star.groupBy("a").agg(F.min("b").alias("low"))
        near = star.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("low").alias("y")),
                                                            F.struct(F.col("b").alias("x"), F.col("low").alias("y")))).alias("e"))
        edges = materialise(near.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
