"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import join_classes, materialise


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Connect the neighbours of every node, those that are larger or those that are not, with the smallest neighbour.

    A node with very many neighbours is joined by broadcast, see ``join_classes``.
    """
    if larger:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    near = materialise(near, "neighbours")
    smallest = materialise(
        near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count("*").alias("n")), "smallest"
    )
    joined = join_classes(near, smallest, "u", "n")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            smallest.select("u", F.col("low").alias("v"))
        )
    return materialise(out.where("u > v").distinct(), "star")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v); a component is named by its smallest node.

    Rounds of two steps until nothing changes, about as many as the logarithm of the number of nodes: every node
    hands its larger neighbours, then the others, to the smallest node it knows.
    """
    current = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges"
    )
    before = _mark(current)
    while before[0]:
        current = _star(_star(current, True), False)
        after = _mark(current)
        if after == before:
            break
        before = after
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(current.select("v", F.col("v").alias("component")).distinct().withColumnRenamed("v", "node"))
