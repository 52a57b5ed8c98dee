"""Connected components of an edge table, by alternating large-star and small-star.

Every node of the result points at the smallest node of its component. Each
round joins the edges with one smallest neighbour per node, so the work of a
round is linear in the edges; a hub's edges are split by the skew join. The
rounds are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    return (both.where("b > a").join(least, F.col("a") == F.col("node"))
            .where("b > least").select(F.col("least").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a < b. The smaller neighbours of a node, and the node itself, go to the smallest."""
    least = edges.groupBy("b").agg(F.min("a").alias("least")).withColumnRenamed("b", "node")
    linked = edges.join(least, F.col("b") == F.col("node"))
    return (linked.where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
            .unionByName(least.select(F.col("least").alias("a"), F.col("node").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    """Count, and an order-free checksum: two rounds with the same state have the same edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("b", "a", F.lit(7)).cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: any two orderable columns); root is the smallest."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
