"""Connected components of a large graph, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest one around the node."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    tied = both.join(least, "u").where("v > u")
    return tied.select(F.col("v").alias("a"), F.least("m", "u").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component: for each end of an edge (a, b), the smallest id it is connected with.

    Rounds until nothing changes, each written to the scratch folder; the driver sees a count
    and a checksum. Counts are summed before they are shuffled, so a node with very many edges
    is no hot spot there, and adaptive execution splits its rows in the joins. Loops and
    repeated edges change nothing, no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(edges.distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = state
        edges = saved(_small_star(_large_star(edges)), "edges")
