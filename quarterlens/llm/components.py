"""Connected components of an edge table by alternating star contractions.

Each round points every node's neighbours at its smallest neighbour, first the
larger ones (large star), then the smaller ones (small star), until the edges
are stars around each component's smallest node.  Rounds grow with the
logarithm of the longest path.  A hot centre only ever meets a map-side
combined minimum and a join whose other side is that one row, which adaptive
execution can split.  Every round is written to the shared folder, and the one
before it removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.llm.common import Steps


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges run from a node ``u`` to a smaller node ``v``."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centre = around.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        out = around.where("v > u").join(centre, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        centre = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(centre, "u").where("v != m")
               .select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(centre.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node.

    Self-loops, repeated edges and either direction are fine; edges with a null
    end are ignored.  No edges give an empty table.
    """
    edges = (edges.where("a != b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    steps, state = Steps(edges.sparkSession), None
    edges = steps.write(edges, tag)
    while True:
        before, edges = edges, steps.write(_star(_star(edges, True), False), tag)
        steps.drop(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)
