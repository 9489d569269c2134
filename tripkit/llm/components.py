"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour of a node to the least node around it. Small star: link the node and its smaller
    neighbours to the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    near = both.groupBy("a").agg(F.min("b").alias("least"))
    linked = both.join(near, "a").withColumn("least", F.least("a", "least"))
    out = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")) if large else \
        linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(linked.select("a", F.col("least").alias("b")))
    return out.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: longs); the component is its least node.

    Each round is written to the shared folder; a node's edges are never gathered in one task (only their minimum).
    Edges from a node to itself, in either direction, and repeated ones are allowed. The rounds grow with the logarithm of the
    longest chain.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = materialize(edges, "components"), None
    while True:
        before, edges = edges, materialize(_star(_star(edges, True), False), "components")
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    # each edge now leads from a node to the least of its component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
