"""Connected components by repeated contraction: every node hooks on to its
least neighbour, pointers are followed to their ends, edges inside a component
go, and the rest is a smaller graph.  All of it stays in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def roots(parent: DataFrame) -> DataFrame:
    """(node, parent) with every pointer followed to its end; parents are less
    than their nodes, so there are no cycles.  Each pass doubles the steps."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        found = materialise(parent.join(up, "parent", "left").select("node", "parent", F.coalesce("grand", "parent").alias("grand")), "graph-pointers")
        if found.filter("grand <> parent").isEmpty():
            return found.select("node", "parent")
        parent = found.select("node", F.col("grand").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: long); comp is the
    component's least node."""
    edges = materialise(edges.filter("a <> b").select("a", "b"), "graph-edges")
    label = None
    while label is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        parent = roots(least.select("node", F.least("node", "b").alias("parent")))
        if label is None:
            label = parent.select("node", F.col("parent").alias("comp"))
        else:
            step = parent.select(F.col("node").alias("comp"), "parent")
            label = label.join(step, "comp", "left").select("node", F.coalesce("parent", "comp").alias("comp"))
        to_a = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        to_b = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = edges.join(to_a, "a").join(to_b, "b").filter("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        edges, label = materialise(edges, "graph-edges"), materialise(label, "graph-labels")
    return label
