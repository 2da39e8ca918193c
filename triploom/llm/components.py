"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.llm.storage import stored


def _to_roots(parents: DataFrame) -> DataFrame:
    """Follow ``parent`` until nothing moves; each step doubles the distance covered."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_up"))
        stepped = stored(
            parents.join(above, "parent").select("node", F.col("_up").alias("parent"), (F.col("_up") != F.col("parent")).alias("_moved")),
            "parents",
        )
        parents = stepped.select("node", "parent")
        if stepped.filter("_moved").isEmpty():
            return parents


def components(edges: DataFrame, one: str, other: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for every node with a link.

    Each round hangs every node below its smallest neighbour, follows these links to their
    roots and keeps only edges between different roots, so a round leaves at most the
    nodes that have no smaller neighbour. Only sums and joins on single keys are used: no
    component or neighbourhood is collected. NULLs and links of a node to itself are
    ignored; an empty input gives an empty table.
    """
    a, b = F.col(one), F.col(other)
    edges = edges.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = stored(edges.distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        parents = parents.select("node", F.least("node", "_least").alias("parent"))
        if labels is None and edges.isEmpty():
            return parents.select("node", F.col("parent").alias("root"))
        roots = _to_roots(stored(parents, "parents"))
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("root"))
        else:
            step = roots.select(F.col("node").alias("root"), "parent")
            labels = labels.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        labels = stored(labels, "labels")
        to_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        to_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        edges = edges.join(to_a, "a").join(to_b, "b").filter("_a != _b")
        edges = edges.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = stored(edges.distinct(), "edges")
        if edges.isEmpty():
            return labels
