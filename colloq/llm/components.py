"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each round is two aggregations and two joins; its edges are written in the shared folder, which cuts the
lineage. The rounds grow with the logarithm of a component's diameter. No component is gathered anywhere: what a
hub node gets is its least neighbour, by a partial aggregation, and the join back can be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint) -> (node, component): every node that has an edge, with the least node it reaches."""
    state = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen, before = mark, state
        state = written(_small_star(_large_star(state)), "edges")
        dropped(before)
