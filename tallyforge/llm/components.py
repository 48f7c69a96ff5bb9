"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of each id of the edges ``a``, ``b`` (longs).

    Every node hooks on its smallest neighbour if that is smaller, then edges and
    labels are replaced by those of the hooks, until no edge is left.  Each round writes three tables and
    at least halves the nodes that are not yet smallest; a hub's edges are summed up before the shuffle
    and its row is joined to edges that adaptive execution splits.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    left = written(edges.filter("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "edges")
    labels = None
    while left.head(1):
        ends = left.select(F.col("b").alias("n"), F.col("a").alias("to")).union(left.select("a", "a"))
        hooks = written(ends.groupBy("n").agg(F.min("to").alias("to")), "hooks")
        step = lambda name: hooks.select(F.col("n").alias(name), F.col("to").alias(f"{name}_to"))  # noqa: B023, E731
        if labels is None:
            labels = hooks.select(F.col("n").alias("id"), F.col("to").alias("component"))
        else:
            moved = labels.join(step("component"), "component", "left")
            labels = written(moved.select("id", F.coalesce("component_to", "component").alias("component")), "labels")
        pairs = left.join(step("a"), "a").join(step("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        left = written(pairs.filter("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
