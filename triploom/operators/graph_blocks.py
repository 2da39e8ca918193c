"""Sums over a graph, block by block.

The vertices are cut into ranges of ids. A task settles all edges inside one range at once;
rounds only carry on what crosses ranges, and only ranges that it raises run again.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from triploom.operators.relaxation import (
    COMPACT_EVERY,
    checked_count,
    hinted,
    latest,
    rise,
)
from triploom.operators.skew import split_hot_keys
from triploom.sources.checkpoints import cut_lineage

# executors get the functions below with the task and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGES = 1_000
OVERFULL = 4
PARENT_CHECK = 8


def block_sums(
    edges: DataFrame, ceiling: float, block_rows: int, hot_rows: int, broadcast_rows: int
) -> DataFrame:
    """``(id, cum)`` of the vertices that edges ``(src, dst, a, b)`` bring a positive sum.

    ``cum`` is the largest ``max(b, a + cum of src)`` over the edges into a vertex. A block
    has about ``block_rows`` edges; where edges inside one range are far more, they are
    treated as edges between ranges, which no task has to hold. A sum above ``ceiling``
    raises: it proves a cycle.
    """
    total = edges.count()
    placed = _placed(edges, math.ceil(total / block_rows))
    inside, cross = placed, placed.limit(0)
    if total > block_rows:
        placed = cut_lineage(placed)
        inside, cross = placed.filter("block = dst_block"), placed.filter("block != dst_block")
        full = inside.groupBy("block").count().filter(F.col("count") > OVERFULL * block_rows)
        full = full.select("block")
        overfull = full.limit(RANGES + 1).count()
        if overfull:
            full = hinted(cut_lineage(full), overfull <= RANGES)
            cross = cross.unionAll(inside.join(full, "block", "left_semi"))
            inside = inside.join(full, "block", "left_anti")
    id_type = edges.schema["src"].dataType.simpleString()
    result = f"id {id_type}, cum double, block long"

    def settle(mine: DataFrame, values: DataFrame) -> DataFrame:
        groups = mine.groupBy("block"), values.groupBy("block")
        settled = groups[0].cogroup(groups[1]).applyInPandas(_settler(ceiling), result)
        return cut_lineage(settled)

    values = placed.select(F.col("src").alias("id"), F.col("a").alias("cum"), "block").limit(0)
    told = settle(inside, values)
    count = checked_count(told, "cum", ceiling)
    if total <= block_rows or cross.isEmpty():
        return told.select("id", "cum")

    cross = cross.select(F.col("src").alias("id"), "dst", "dst_block", "a", "b")
    cross, spread, keys = split_hot_keys(cross, ["id"], "dst", hot_rows=hot_rows)
    cross = cut_lineage(cross)
    raised, sent, how = [told], told, "left"  # in the first round sources at 0 send as well
    total = count
    while True:
        ready = spread(sent.select("id", "cum"))
        reach = F.greatest("b", F.col("a") + F.coalesce("cum", F.lit(0.0)))
        offers = cross.join(hinted(ready, how == "inner" and count <= broadcast_rows), keys, how)
        offers = offers.select(
            F.col("dst").alias("id"), F.col("dst_block").alias("block"), reach.alias("cum")
        ).filter("cum > 0")
        offers = offers.groupBy("id", "block").agg(F.max("cum").alias("cum"))
        frontier = rise(offers, raised, ["id", "block"], total, broadcast_rows)
        count = checked_count(frontier, "cum", ceiling)
        if count == 0:
            return latest(raised, ["id"])
        raised.append(frontier)
        if len(raised) > COMPACT_EVERY:
            raised = [cut_lineage(latest(raised, ["id", "block"]))]
        woken = cut_lineage(frontier.select("block").distinct())
        woken = hinted(woken, woken.count() <= broadcast_rows)
        known = latest(raised, ["id", "block"]).join(woken, "block", "left_semi")
        told = settle(inside.join(woken, "block", "left_semi"), known)
        count += checked_count(told, "cum", ceiling)
        raised.append(told)
        total += count
        sent = latest([frontier, told], ["id", "block"])
        how = "inner"


def _placed(edges: DataFrame, blocks: int) -> DataFrame:
    """``edges`` with the blocks of both ends: ranges of ids with about as many edges each."""
    if blocks <= 1:
        return edges.withColumns({"block": F.lit(0).cast("long"), "dst_block": F.lit(0).cast("long")})
    numeric = isinstance(edges.schema["src"].dataType, IntegralType)
    place = {c: (F.col(c) if numeric else F.xxhash64(c)).cast("double") for c in ("src", "dst")}
    rows = edges.withColumns({f"_{c}": value for c, value in place.items()})
    ranges = min(blocks, RANGES)
    shares = [i / ranges for i in range(ranges + 1)]
    quantiles = F.percentile_approx("_src", F.array(*map(F.lit, shares)), 10 * RANGES)
    cuts = sorted(set(rows.agg(quantiles).first()[0]))
    splits = [-math.inf, *cuts[1:-1], math.inf]
    parts = math.ceil(blocks / max(len(cuts) - 1, 1))
    if len(splits) > 2:
        names = {"splitsArray": [splits] * 2, "inputCols": ["_src", "_dst"], "outputCols": ["_s", "_d"]}
        rows = Bucketizer(**names).transform(rows)
    else:
        rows = rows.withColumns({"_s": F.lit(0.0), "_d": F.lit(0.0)})
    starts, ends = (F.array(*map(F.lit, x)) for x in (cuts[:-1] or cuts, cuts[1:] or cuts))

    def block(value: str, bucket: str) -> Column:
        at = F.col(bucket).cast("int") + 1
        low, high = F.element_at(starts, at), F.element_at(ends, at)
        part = F.floor((F.col(value) - low) * parts / F.greatest(high - low, F.lit(1.0)))
        return F.col(bucket).cast("long") * parts + F.greatest(F.least(part, F.lit(parts - 1)), F.lit(0))

    rows = rows.withColumns({"block": block("_src", "_s"), "dst_block": block("_dst", "_d")})
    return rows.drop("_src", "_dst", "_s", "_d")


def _settler(ceiling: float):
    def settle(edges: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        ends = pd.concat([edges["src"], edges["dst"], values["id"]], ignore_index=True)
        codes, ids = pd.factorize(ends)
        src, dst, at = np.split(codes, [len(edges), 2 * len(edges)])
        known = np.zeros(len(ids))
        known[at] = values["cum"].to_numpy()
        b = edges["b"].to_numpy(dtype=float, na_value=-np.inf)
        b[np.isnan(b)] = -np.inf
        cum = settled(src, dst, edges["a"].to_numpy(), b, known, ceiling)
        rose = cum > known
        block = edges["block"].iloc[0] if len(edges) else 0
        return pd.DataFrame({"id": ids[rose], "cum": cum[rose], "block": block})

    return settle


def settled(
    src: np.ndarray, dst: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, ceiling: float
) -> np.ndarray:
    """The largest sum at each vertex, given the least one that is ``known``.

    Vertices are done when all edges into them are, so every edge is looked at once; what
    depends on a cycle is repeated until it stands still. Vertices on a cycle that gains
    weight get an infinite sum.
    """
    cum = known.copy()
    order = np.argsort(src, kind="stable")
    src, dst, a, b = src[order], dst[order], a[order], b[order]
    first = np.searchsorted(src, np.arange(len(known) + 1))
    missing = np.bincount(dst, minlength=len(known))
    ready = np.flatnonzero(missing == 0)
    todo = np.ones(len(known), bool)
    while len(ready):
        todo[ready] = False
        n = first[ready + 1] - first[ready]
        edges = np.repeat(first[ready] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        to = dst[edges]
        np.maximum.at(cum, to, np.maximum(b[edges], a[edges] + cum[src[edges]]))
        np.subtract.at(missing, to, 1)
        ready = np.unique(to[missing[to] == 0])
    if todo.any():
        rest = todo[src]
        _repeat(src[rest], dst[rest], a[rest], b[rest], cum, ceiling)
    return cum


def _repeat(
    src: np.ndarray, dst: np.ndarray, a: np.ndarray, b: np.ndarray, cum: np.ndarray, ceiling: float
) -> None:
    """Raise ``cum`` until nothing rises, or to infinity along a cycle of best predecessors."""
    parent = np.full(len(cum), -1)
    check, rounds = PARENT_CHECK, 0
    while True:
        offer = np.maximum(b, a + cum[src])
        better = offer > cum[dst]
        if not better.any():
            return
        np.maximum.at(cum, dst[better], offer[better])
        best = better & (offer == cum[dst])
        parent[dst[best]] = src[best]
        rounds += 1
        if rounds == check:
            check *= 2
            ancestor = np.where(parent < 0, np.arange(len(cum)), parent)
            for _ in range(len(cum).bit_length()):
                ancestor = ancestor[ancestor]
            endless = parent[ancestor] >= 0
            if endless.any() or cum.max() > 2 * ceiling:
                cum[ancestor[endless] if endless.any() else cum > 2 * ceiling] = np.inf
                return
