"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import staged


def _min_of_neighbours(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with) for each node of
    ``edges`` (u, v: not null, unlike).

    Alternating large and small stars: each round joins the edges with the smallest
    neighbour of their ends, so a hub's edges are spread by the skew handling of
    joins and no component is held in one place. Rounds grow with the logarithm of
    the nodes and each is written to the shared folder.
    """
    spark = edges.sparkSession
    edges = staged(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .filter("u != v").distinct(), "cc-edges")
    before = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct())
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_min_of_neighbours(both), "u").filter("v > u and v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staged(spark, large, "cc-large")
        lowest = _min_of_neighbours(large)
        small = (large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        edges = staged(spark, small, "cc-small")
