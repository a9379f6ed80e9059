"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node of ``edges`` (``a``, ``b``, long).

    Each round hooks every node to its least neighbour, follows these pointers a few steps, and goes
    on with the edges between what is left, at most half as many nodes. All tables stay distributed
    and are written once per round. No edges give no rows; loops and repeated edges are fine.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    graph = materialise(both.distinct(), "graph")
    roots = None
    while True:
        least = graph.groupBy("a").agg(F.min("b").alias("b"))
        hook = least.select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hook = materialise(hook, "hooks")
        for _ in range(2):
            above = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = hook.join(above, "up").select("node", F.col("top").alias("up"))
        hook = materialise(hook, "hooks")
        if roots is None:
            roots = hook
        else:
            ups = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            roots = roots.join(ups, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
            roots = materialise(roots, "roots")
        graph = (
            graph.join(hook.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            .filter(F.col("x") != F.col("y"))
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
        graph = materialise(graph, "graph")
        if graph.isEmpty():
            return roots.select("node", F.col("up").alias("component"))
