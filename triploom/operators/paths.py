"""The trips of the heaviest chains, in order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.operators.ranking import top_k
from triploom.operators.skew import HOT_ROWS, split_hot_keys
from triploom.sources.checkpoints import cut_lineage

BLOCK_ROWS = 500_000


def chain_paths(
    result: DataFrame, k: int = 1, hot_rows: int = HOT_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(chain, position, tripID)`` of the ``k`` heaviest chains, each from its start.

    ``result`` is the output of a chain operator. Equal chains rank by trip id.

    Up to ``block_rows`` predecessor links, one task walks back along them. More are squared: after n rounds a link spans 2ⁿ trips, so a chain of
    L trips takes about log₂ L rounds. Only links that exist in full are kept, so the
    table of links shrinks with every round. A link that spans more trips than there are
    links proves a cycle and raises.
    """
    best = top_k(result, "longestDistance", k, ["tripID"])
    rank = Window.orderBy(F.desc("longestDistance"), "tripID")  # over k rows
    found = cut_lineage(
        best.select(
            F.row_number().over(rank).alias("chain"),
            F.col("tripID").alias("trip"),
            F.lit(0).alias("back"),
        )
    )
    links = result.filter(F.col("previousTripID") != F.col("tripID")).select(
        F.col("tripID").alias("trip"), F.col("previousTripID").alias("ancestor")
    )
    links = cut_lineage(links)
    longest, span = links.count(), 1
    if longest <= block_rows:
        walked = cut_lineage(_walked(found, links))
        if not walked.filter("trip is null").isEmpty():
            raise RuntimeError("the predecessors have a cycle")
        return _positions(walked)
    while span <= 2 * longest:
        reached = cut_lineage(
            found.join(links, "trip").select(
                "chain", F.col("ancestor").alias("trip"), (F.col("back") + span).alias("back")
            )
        )
        if reached.isEmpty():
            return _positions(found)
        found = found.unionAll(reached)
        links = cut_lineage(_squared(links, hot_rows))
        span *= 2
    if longest:
        raise RuntimeError("the predecessors have a cycle")
    return _positions(found)


def _walked(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` and all that lies before its trips; a trip of NULL says that a chain never ends."""

    def walk(ends: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        before = dict(zip(steps["trip"], steps["ancestor"], strict=True))
        rows = []
        for chain, trip in zip(ends["chain"], ends["trip"], strict=True):
            back = 0
            while trip is not None:
                rows.append((chain, trip, back))
                trip, back = before.get(trip), back + 1
                if back > len(before) + 1:
                    rows.append((chain, None, back))
                    break
        return pd.DataFrame(rows, columns=["chain", "trip", "back"]).astype({"trip": object})

    kind = found.schema["trip"].dataType.simpleString()
    one = F.lit(0).alias("all")
    groups = found.groupBy(one).cogroup(links.groupBy(one))
    return groups.applyInPandas(walk, f"chain int, trip {kind}, back int")


def _positions(found: DataFrame) -> DataFrame:
    lengths = found.groupBy("chain").agg(F.max("back").alias("longest"))
    return found.join(F.broadcast(lengths), "chain").select(
        "chain",
        (F.col("longest") - F.col("back") + 1).alias("position"),
        F.col("trip").alias("tripID"),
    )


def _squared(links: DataFrame, hot_rows: int) -> DataFrame:
    """Links that span twice as far; any trip may be the ancestor of many."""
    near = links.select(F.col("trip"), F.col("ancestor").alias("middle"))
    far = links.select(F.col("trip").alias("middle"), "ancestor")
    near, spread, keys = split_hot_keys(near, ["middle"], "trip", hot_rows=hot_rows)
    return near.join(spread(far), keys).select("trip", "ancestor")


def chain_text(paths: DataFrame) -> DataFrame:
    """One row per chain with its trips as text, start to end: ``a > b > c``."""
    trips = F.array_sort(F.collect_list(F.struct("position", "tripID")))
    return paths.groupBy("chain").agg(
        F.array_join(F.transform(trips, lambda t: t["tripID"].cast("string")), " > ").alias(
            "path"
        )
    )
