"""Runs of a graph drawn together, so that a long line costs few rounds.

A run is a line of vertices each of which has one successor, which has no other
predecessor. What reaches a vertex of a run depends on its head alone: with ``x`` the sum
at the head it is ``max(b, a + x)``. Such steps compose, so pointers along the runs are
doubled round by round, and only heads and the edges between runs remain.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.operators.skew import Spread
from triploom.sources.checkpoints import cut_lineage


def single_steps(links: DataFrame) -> DataFrame:
    """The edges ``(id, dst, a)`` whose source has no other and whose target is in no other."""
    one_after = (
        links.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("dst").alias("dst"), F.max("weight").alias("a"))
        .filter("n = 1")
        .drop("n")
    )
    one_before = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"))
    steps = one_after.join(one_before.filter("n = 1").drop("n"), ["id", "dst"])
    return steps.filter("id != dst")


def runs_of(links: DataFrame) -> DataFrame:
    """``(id, head, a, b)`` for every vertex of a run but its head.

    ``links`` has a row ``(id, dst, weight)`` per edge, ``weight`` being what the edge adds
    to the sum at ``id``. Each round doubles the reach of the pointers, so a run of L
    vertices takes about log₂ L rounds. A run that is closed to a circle has no head; its
    vertices are left out.
    """
    waiting = cut_lineage(
        single_steps(links).select(
            F.col("dst").alias("id"), F.col("id").alias("head"), "a", F.lit(0.0).alias("b")
        )
    )
    longest, span = waiting.count(), 1
    nothing = waiting.limit(0)
    settled: list[DataFrame] = []
    while span <= 2 * longest:
        known = reduce(DataFrame.unionAll, settled, waiting)
        before = known.select(
            F.col("id").alias("head"),
            F.col("head").alias("_head"),
            F.col("a").alias("_a"),
            F.col("b").alias("_b"),
        )
        moved = F.col("_head").isNotNull()
        stepped = waiting.join(before, "head", "left").select(
            "id",
            F.coalesce("_head", "head").alias("head"),
            (F.col("a") + F.coalesce("_a", F.lit(0.0))).alias("a"),
            F.greatest("b", F.col("a") + F.col("_b")).alias("b"),
            moved.alias("moved"),
        )
        stepped = cut_lineage(stepped)
        settled.append(stepped.filter("not moved").drop("moved"))
        waiting = stepped.filter("moved").drop("moved")
        if waiting.isEmpty():
            break
        span *= 2
    return reduce(DataFrame.unionAll, settled, nothing)


def contracted(
    links: DataFrame, runs: DataFrame, spread: Spread, keys: Sequence[str]
) -> DataFrame:
    """The edges ``(src, dst, a, b)`` that remain when every run is drawn to its head.

    Along an edge, ``max(b, a + sum at src)`` is offered; ``b`` is NULL where the source is
    no member of a run. ``spread`` and ``keys`` are those of ``links``.
    """
    rest = links.join(runs.select(F.col("id").alias("dst")), "dst", "left_anti")
    members = runs.select("id", "head", F.col("a").alias("run_a"), F.col("b").alias("run_b"))
    weight = F.col("weight")
    return rest.join(spread(members), list(keys), "left").select(
        F.coalesce("head", "id").alias("src"),
        "dst",
        (weight + F.coalesce("run_a", F.lit(0.0))).alias("a"),
        (weight + F.col("run_b")).alias("b"),
    )


def expanded(sums: DataFrame, runs: DataFrame) -> DataFrame:
    """``sums`` (``id``, ``cum``) of the heads and the vertices of their runs."""
    heads = sums.select(F.col("id").alias("head"), "cum")
    reach = F.greatest("b", F.col("a") + F.coalesce("cum", F.lit(0.0)))
    inside = runs.join(heads, "head", "left").select("id", reach.alias("cum"))
    return sums.select("id", "cum").unionAll(inside.filter("cum > 0"))
