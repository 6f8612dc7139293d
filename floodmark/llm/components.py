"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for each node of `edges` (a, b): component is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows that pointer twice, and keeps the edges whose ends
    still differ, so a chain of n nodes needs about log n rounds. Nodes without an edge are absent. Nothing is held in
    the driver: only whether edges are left.
    """
    rest = scratch.keep(edges.select("a", "b").filter("a <> b").distinct())
    label = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("up")))
        over = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hooked = scratch.keep(up.join(over, "up").select("node", "top"))
        ends = hooked.select(F.col("node").alias("a"), F.col("top").alias("x"))
        far = hooked.select(F.col("node").alias("b"), F.col("top").alias("y"))
        left = scratch.keep(
            rest.join(ends, "a").join(far, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        if label is None:
            new = hooked.withColumnRenamed("top", "component")
        else:
            step = hooked.select(F.col("node").alias("component"), "top")
            new = scratch.keep(
                label.join(step, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
            )
        scratch.drop(rest, up)
        rest, label = left, new
    if label is None:
        label = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return label
