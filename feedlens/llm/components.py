"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import land


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(down.groupBy("a").agg(F.min("b").alias("m")), "a")
    moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(joined.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for each node of ``edges(a, b)`` that is
    not itself the smallest. Each step groups with map-side minima and joins back, so a node
    may have any number of edges; rounds grow with the logarithm of the longest path. Steps
    are landed, nothing but a count and a checksum reaches the driver."""
    now = land(edges.where("a <> b").distinct(), "edges")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if (row["n"], row["x"]) == mark or not row["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = (row["n"], row["x"])
        now = land(_small(_large(now)), "edges")
