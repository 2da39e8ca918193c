"""The fixed-point loop behind the chain operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.sources.checkpoints import cut_lineage

COMPACT_EVERY = 16
ROUNDING = 1e-6
BROADCAST_ROWS = 200_000

Propose = Callable[[DataFrame, bool], DataFrame]


def relax(
    offers: DataFrame,
    keys: Sequence[str],
    propose: Propose,
    ceiling: float,
    max_rounds: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Largest ``cum`` per key that can be reached from the first ``offers``.

    ``offers`` holds positive values of ``cum`` per key; a key without a row stands at
    zero. Each round stores the offers that beat what is known, and
    ``propose(frontier, small)`` turns those into the next ones, until none is left.

    ``ceiling`` is the sum of all positive weights. A path without repeats can't hold more,
    so a larger ``cum`` proves a cycle; the number of rounds needs no limit. ``max_rounds``
    is for callers who want one.

    A round writes only the rows it raised, which also ends its lineage. ``small`` says
    that the frontier was counted and has at most ``broadcast_rows`` rows, so it may be
    broadcast and the large tables stay where they are; beyond that both sides shuffle.
    """
    raised: list[DataFrame] = []
    counts: list[int] = []
    total = 0
    while max_rounds is None or len(counts) < max_rounds:
        frontier = rise(offers, raised, keys, total, broadcast_rows)
        count = checked_count(frontier, "cum", ceiling)
        counts.append(count)
        raised.append(frontier)
        if count == 0:
            return latest(raised, keys)
        total += count
        if len(raised) > compact_every:
            raised = [cut_lineage(latest(raised, keys))]
        offers = propose(frontier, count <= broadcast_rows)
    raise RuntimeError(f"chains still grow after max_rounds={max_rounds}")


def positive_total(df: DataFrame, weight: str = "weight") -> float:
    """Sum of the weights above zero: no path can hold more."""
    return df.agg(F.sum(F.greatest(F.col(weight), F.lit(0.0)))).first()[0] or 0.0


def checked_count(df: DataFrame, value: str, ceiling: float) -> int:
    """The number of rows; raises if a value proves that the graph has a cycle."""
    count, top = df.agg(F.count(F.lit(1)), F.max(value)).first()
    if top is not None and top > ceiling * (1 + ROUNDING):
        raise RuntimeError("a chain outweighs all trips together: the graph has a cycle (cycles() names its trips)")
    return count


def rise(
    offers: DataFrame,
    raised: Sequence[DataFrame],
    keys: Sequence[str],
    total: int,
    broadcast_rows: int,
) -> DataFrame:
    """The offers above everything raised so far, stored.

    Offers and earlier values are compared in one aggregation. When the earlier ones
    are many (``total`` rows) but the offers few, only those they meet are shuffled.
    """
    if not raised:
        return cut_lineage(offers)
    met = raised
    if total > broadcast_rows:
        offers = offers.persist()
        if offers.count() <= broadcast_rows:
            wanted = F.broadcast(offers.select(*keys))
            met = [r.join(wanted, list(keys), "left_semi") for r in raised]
    none = F.lit(None).cast("double")
    rows = offers.select(*keys, F.col("cum").alias("offer"), none.alias("known"))
    for earlier in met:
        rows = rows.unionAll(earlier.select(*keys, none, "cum"))
    better = (
        rows.groupBy(*keys)
        .agg(F.max("offer").alias("cum"), F.max("known").alias("known"))
        .filter(F.col("cum") > F.coalesce("known", F.lit(0.0)))
        .select(*keys, "cum")
    )
    frontier = cut_lineage(better)
    offers.unpersist()
    return frontier


def latest(raised: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The largest ``cum`` of every key over all rounds."""
    rows = reduce(DataFrame.unionAll, [r.select(*keys, "cum") for r in raised])
    return rows.groupBy(*keys).agg(F.max("cum").alias("cum"))


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
