"""The cycles of a graph: its strongly connected components of more than one vertex."""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.operators.contraction import runs_of, single_steps
from triploom.operators.skew import HOT_ROWS, split_hot_keys
from triploom.operators.successors import successor_edges
from triploom.schema import TRIP_COLUMNS, TripColumns
from triploom.sources.checkpoints import cut_lineage

# executors get the functions below with the task and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 500_000
#: Trimming goes on while a round takes away at least this share of the edges.
WORTHWHILE = 0.05


def cycles(edges: DataFrame, block_rows: int = BLOCK_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(cycle, tripID)``: the vertices of every cycle of ``edges`` (``src``, ``dst``).

    Vertices that can reach each other are one cycle, named by its smallest id; a vertex with
    an edge to itself is one alone. Repeated edges count once, edges with a NULL end for
    nothing; a graph without cycles gives no rows.

    Runs of single successors are drawn together first and circles are found by doubling
    pointers, so long lines and long circles take logarithmic rounds. Then vertices without a
    predecessor or a successor are trimmed. Once at most ``block_rows`` edges are left, one
    task walks them; before that, every vertex learns the largest id that reaches it, and
    those that reach that id back are its component.
    """
    links = edges.filter("src is not null and dst is not null").select("src", "dst").distinct()
    links = cut_lineage(links)
    found = [_selves(links)]
    core = links.filter("src != dst")
    if core.limit(block_rows + 1).count() <= block_rows:
        return _named([*found, _walked(core)])
    weighted = core.select(F.col("src").alias("id"), "dst", F.lit(0.0).alias("weight"))
    runs = cut_lineage(runs_of(weighted).select("id", "head"))
    circles = _circles(weighted, runs)
    head = F.coalesce("head", "src")
    rest = core.join(runs.select(F.col("id").alias("dst")), "dst", "left_anti")
    rest = rest.join(circles.select(F.col("tripID").alias("dst")), "dst", "left_anti")
    rest = rest.join(runs.select(F.col("id").alias("src"), "head"), "src", "left")
    rest = cut_lineage(rest.select(head.alias("src"), "dst").distinct())
    found.append(_selves(rest))
    core = rest.filter("src != dst")
    while True:
        core = _trimmed(core, block_rows)
        if core.limit(block_rows + 1).count() <= block_rows:
            found.append(_walked(core))
            break
        component = cut_lineage(_components_of_largest(core, hot_rows))
        sizes = component.groupBy("cycle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found.append(component.join(sizes.select("cycle"), "cycle", "left_semi"))
        for end in ("src", "dst"):
            core = core.join(component.select(F.col("tripID").alias(end)), end, "left_anti")
        core = cut_lineage(core)
    return _named([*found, circles], runs)


def trip_cycles(
    trips: DataFrame, max_idle_s: float = 300, cols: TripColumns = TRIP_COLUMNS, **options: int
) -> DataFrame:
    """The cycles of trips that may follow each other, trips that end before they start included.

    Where there are none, the chain operators take ``invalid_trips="keep"``.
    """
    return cycles(successor_edges(trips, max_idle_s, "keep", cols=cols), **options)


def _selves(links: DataFrame) -> DataFrame:
    own = links.filter("src = dst")
    return own.select(F.col("src").alias("cycle"), F.col("src").alias("tripID"))


def _named(found: list[DataFrame], runs: DataFrame | None = None) -> DataFrame:
    """The union of ``found`` with the runs of its vertices, each cycle named by its smallest id."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    # a vertex with an edge to itself may be on a longer cycle too
    longer = F.max_by("cycle", F.col("cycle") != F.col("tripID")).alias("cycle")
    rows = cut_lineage(rows.groupBy("tripID").agg(longer))
    if runs is not None:
        members = runs.select(F.col("id").alias("member"), F.col("head").alias("tripID"))
        inside = members.join(rows, "tripID").select(F.col("member").alias("tripID"), "cycle")
        rows = cut_lineage(rows.unionByName(inside).groupBy("tripID").agg(longer))
    smallest = rows.groupBy("cycle").agg(F.min("tripID").alias("name"))
    return rows.join(smallest, "cycle").select(F.col("name").alias("cycle"), "tripID")


def _circles(weighted: DataFrame, runs: DataFrame) -> DataFrame:
    """Lines that close on themselves and touch nothing else, by doubling pointers to the smallest id."""
    steps = single_steps(weighted).select(F.col("dst").alias("id"), F.col("id").alias("up"))
    ring = cut_lineage(steps.join(runs.select("id"), "id", "left_anti").withColumn("least", F.least("id", "up")))
    longest, span = ring.count(), 1
    while span < longest:
        ahead = ring.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("least").alias("_least"))
        ring = cut_lineage(ring.join(ahead, "up").select("id", F.col("_up").alias("up"), F.least("least", "_least").alias("least")))
        span *= 2
    return ring.select(F.col("least").alias("cycle"), F.col("id").alias("tripID"))


def _trimmed(core: DataFrame, block_rows: int) -> DataFrame:
    """``core`` without edges from vertices that nothing leads to or into such that lead nowhere."""
    left = core.count()
    while left > block_rows:
        into = core.select(F.col("dst").alias("src")).distinct()
        out_of = core.select(F.col("src").alias("dst")).distinct()
        core = cut_lineage(core.join(into, "src", "left_semi").join(out_of, "dst", "left_semi").select("src", "dst"))
        before, left = left, core.count()
        if before - left < WORTHWHILE * before:
            break
    return core


def _components_of_largest(core: DataFrame, hot_rows: int) -> DataFrame:
    """``(cycle, tripID)`` of the vertices that the largest id reaching them is reached from."""
    ends = core.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    colors = cut_lineage(ends.withColumn("color", F.col("id")))
    by_source, spread, keys = split_hot_keys(core.select(F.col("src").alias("id"), "dst"), ["id"], "dst", hot_rows=hot_rows)
    by_source = cut_lineage(by_source)
    fresh = colors
    while True:
        offers = by_source.join(spread(fresh), keys).groupBy(F.col("dst").alias("id")).agg(F.max("color").alias("offer"))
        stepped = colors.join(offers, "id", "left").select(
            "id", F.greatest("color", "offer").alias("color"), F.coalesce(F.col("offer") > F.col("color"), F.lit(False)).alias("rose")
        )
        stepped = cut_lineage(stepped)
        colors, fresh = stepped.drop("rose"), stepped.filter("rose").drop("rose")
        if fresh.isEmpty():
            break
    inside = core.join(colors.select(F.col("id").alias("src"), "color"), "src")
    inside = inside.join(colors.select(F.col("id").alias("dst"), "color"), ["dst", "color"])
    by_target, spread, keys = split_hot_keys(inside.select(F.col("dst").alias("id"), "color", "src"), ["id"], "src", hot_rows=hot_rows)
    by_target = cut_lineage(by_target.select(*keys, "src"))
    reached = cut_lineage(colors.filter("id = color"))
    fresh = reached
    while True:
        found = by_target.join(spread(fresh), keys).select(F.col("src").alias("id"), "color").distinct()
        fresh = cut_lineage(found.join(reached.select("id"), "id", "left_anti"))
        if fresh.isEmpty():
            return reached.select(F.col("color").alias("cycle"), F.col("id").alias("tripID"))
        reached = cut_lineage(reached.unionByName(fresh))


def _walked(core: DataFrame) -> DataFrame:
    """The components of a graph that one task can hold."""
    kind = core.schema["src"].dataType.simpleString()

    def walk(edges: pd.DataFrame) -> pd.DataFrame:
        codes, ids = pd.factorize(pd.concat([edges["src"], edges["dst"]], ignore_index=True))
        label = components(codes[: len(edges)], codes[len(edges) :], len(ids))
        shared = np.bincount(label)[label] > 1
        table = pd.DataFrame({"cycle": label, "tripID": ids})[shared]
        table["cycle"] = table.groupby("cycle")["tripID"].transform("min")
        return table

    return core.groupBy(F.lit(0).alias("all")).applyInPandas(walk, f"cycle {kind}, tripID {kind}")


def components(src: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
    """The strongly connected component of each of ``n`` vertices, by one walk in depth.

    Every vertex gets a number when it is met and the lowest number that it can climb to; a
    vertex that climbs no higher than itself closes a component.
    """
    after = defaultdict(list)
    for s, d in zip(src.tolist(), dst.tolist(), strict=True):
        after[s].append(d)
    met, low, label = [-1] * n, [0] * n, [-1] * n
    open_, clock = [], 0
    for root in range(n):
        if met[root] >= 0:
            continue
        path = [(root, iter(after[root]))]
        met[root] = low[root] = clock
        clock += 1
        open_.append(root)
        while path:
            v, others = path[-1]
            for w in others:
                if met[w] < 0:
                    met[w] = low[w] = clock
                    clock += 1
                    open_.append(w)
                    path.append((w, iter(after[w])))
                    break
                if label[w] < 0:
                    low[v] = min(low[v], met[w])
            else:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[v])
                if low[v] == met[v]:
                    while True:
                        w = open_.pop()
                        label[w] = v
                        if w == v:
                            break
    return np.array(label, np.int64)
