"""Connected components of an edge table, by alternating large and small stars.

Each round reads and writes an edge table of at most as many rows; labels never leave the cluster.
A vertex with very many edges only ever takes part in a minimum (combined before the shuffle) and in
an equi-join whose hot keys Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a vertex to the least vertex around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every vertex and its smaller neighbours to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for each vertex of ``edges`` (a, b: long): the least vertex that it reaches.

    Loops and repeated edges are allowed; without edges the result is empty. The number of rounds
    grows with the logarithm of the longest path; only a count and a checksum of the edges come to
    the driver."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")  # a round reads them four times
    before = None
    while True:
        edges = written(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
        before = now
