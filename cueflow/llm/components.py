"""Connected components by contraction, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.shared import materialise


def jumped(hooks: DataFrame) -> DataFrame:
    """Follows (node, root) pointers, each to a smaller node, to their ends."""
    while True:
        to = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        further = hooks.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = materialise(further, "jump")
        hooks = further.drop("moved")
        if further.filter("moved").isEmpty():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b) but the roots, where the root is the smallest node of the component.

    Each round hooks every node on its smallest smaller neighbour, follows the pointers, and contracts the edges; a round at least
    halves the nodes that still have edges, and no step gathers a component.
    """
    done = None
    left = edges.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    while True:
        left = materialise(left, "edges")
        if left.isEmpty():
            return done if done is not None else left.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        hooks = jumped(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        to = lambda name: hooks.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        renamed = left.join(to("hi"), "hi", "left").join(to("lo"), "lo", "left").select(F.coalesce("hi_root", "hi").alias("a"), F.coalesce("lo_root", "lo").alias("b"))
        left = renamed.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
        if done is None:
            done = hooks
        else:
            done = done.join(to("root"), "root", "left").select("node", F.coalesce("root_root", "root").alias("root")).unionByName(hooks)
