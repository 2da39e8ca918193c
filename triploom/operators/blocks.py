"""Chain sums of one block of legs, and the cut of the legs into blocks.

A leg is a distinct (pickup place and time, drop-off place and time) with the largest
weight of its trips. A block holds the legs that start in one slab of time, at most
about ``block_rows`` of them, so it fits one task whatever the size of the table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.operators.skew import split_hot_keys

# executors get the functions below with the task and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICROS = 1_000_000
STRETCH = 1_000
LEG = ["place", "time", "to_place", "to_time"]
BLOCK = ["zone", "salt", "slab"]


class Cut(NamedTuple):
    """Slabs are ``length`` microseconds long, slab 0 begins at ``first``; a zone has ``span`` slabs.

    ``calm`` says that no slab was split.
    """

    first: int
    length: int
    span: int
    calm: bool


def cut_into_blocks(legs: DataFrame, block_rows: int, zones: int) -> tuple[DataFrame, Cut]:
    """Add ``slab``, ``salt`` and ``zone``, the first slab of the zone; also returns the cut.

    Slabs are equally long, in microseconds, and sized so that a usual one is half full.
    Those with more than ``block_rows`` legs are split by hashed leg. Up to ``block_rows``
    legs are one slab. Successive slabs make about ``zones`` zones, however many slabs the
    legs need.
    """
    bulk = F.percentile_approx("time", F.array(F.lit(0.01), F.lit(0.99)), 1000)
    rows, bounds, least, most = legs.agg(F.count("time"), bulk, F.min("time"), F.max("time")).first()
    low, high = bounds or (0, 0)
    if 0 < rows <= block_rows:
        low, high = least, most
    share = block_rows / (2.0 * max(rows, 1)) if rows > block_rows else 1.0
    length = max(int((high - low + MICROS) * min(share, 1.0)), MICROS)
    first = int(low)
    span = max(math.ceil((high - low) / length / zones), 1)
    legs = legs.withColumn("slab", slab_of("time", first, length))
    legs, _, keys = split_hot_keys(legs, ["slab"], LEG, hot_rows=block_rows)
    calm = "salt" not in keys
    if calm:
        legs = legs.withColumn("salt", F.lit(0))
    return legs.withColumn("zone", zone_of("slab", span)), Cut(first, length, span, calm)


def slab_of(time: str, first: int, length: int) -> Column:
    since = f"({time} - {first})"
    return F.expr(f"({since} - pmod({since}, {length})) div {length}")


def zone_of(slab: str, span: int) -> Column:
    return F.expr(f"{slab} - pmod({slab}, {span})")


def in_zones(rows: DataFrame) -> DataFrame:
    """The legs dealt to tasks for ``block_settler``: whole zones, and split slabs piece by piece."""
    place = F.when(F.col("salt") == 0, F.col("zone")).otherwise(F.col("slab"))
    rows = rows.select(*BLOCK, *LEG, "weight", "cum", "fresh", place.alias("_at"))
    return rows.repartition("_at", "salt").sortWithinPartitions(*BLOCK).drop("_at")


def block_settler(
    width: int, cut: Cut, block_rows: int
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Function from the legs of blocks, in order, to what the rest of the table must learn.

    Input: leg, weight, the known ``cum`` of its pickup point, and whether that point is
    ``fresh``, that is raised from outside since the block last ran. Output, as
    ``(settled, place, time, value)``: the points raised inside the block, and the
    arrivals that may reach points outside.

    The blocks of a zone follow each other in one task, which holds one of them, and carries
    on at most ``block_rows`` arrivals from each to the next ones. So a round settles whole
    zones, and the rounds don't grow with the slabs.
    """

    def settle_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zone, carried = None, None
        for (own, salt, slab), block in _blocks(batches):
            start = cut.first + slab * cut.length
            if own != zone or salt:
                zone, carried = own, None
            if carried is not None:
                carried = carried[_last_seen(carried["time"], width) > start]
            news, sent = settle(block, salt, slab, carried)
            yield from (n for n in news if len(n))
            if not salt and sent is not None:
                on = sent[_last_seen(sent["time"], width) > start + cut.length]
                carried = on if carried is None else pd.concat([carried, on], ignore_index=True)
                carried = carried.groupby(["place", "time"], as_index=False)["value"].max()
                if len(carried) > block_rows:
                    yield carried.assign(settled=False)
                    carried = None

    def settle(
        block: pd.DataFrame, salt: int, slab: int, carried: pd.DataFrame | None
    ) -> tuple[list[pd.DataFrame], pd.DataFrame | None]:
        """What others must learn, and all arrivals that leave the block."""
        time, to_time = block["time"].to_numpy(), block["to_time"].to_numpy()
        weight = block["weight"].to_numpy()
        places = [block["place"], block["to_place"]]
        if carried is not None and len(carried):
            places.append(carried["place"])
        codes, _ = pd.factorize(pd.concat(places, ignore_index=True))
        place, to_place, brought_to = np.split(codes, [len(block), 2 * len(block)])

        # points, and for each leg the point it starts from
        order = np.lexsort((time, place))
        starts = np.ones(len(block), dtype=bool)
        starts[1:] = (np.diff(place[order]) != 0) | (np.diff(time[order]) != 0)
        at = np.empty(len(block), dtype=np.int64)
        at[order] = np.cumsum(starts) - 1
        sample = order[starts]
        known = block["cum"].to_numpy()[sample]

        offered = known
        if len(brought_to):
            order, keys, low, high = _in_reach(
                place[sample], time[sample], brought_to, carried["time"].to_numpy(), width
            )
            values = carried["value"].to_numpy()[order]
            best = _range_max(values, np.searchsorted(keys, low), np.searchsorted(keys, high))
            offered = np.maximum(known, best)
        fresh = block["fresh"].to_numpy()
        if not fresh.any() and (offered == known).all():
            return [], None
        cum = _relaxed(
            offered, at, place[sample], time[sample], to_place, to_time, weight, width
        )

        rose = cum > known
        value = weight + cum[at]
        sends = (rose[at] | fresh) & (value > 0)
        if not salt:
            slab_start = cut.first + slab * cut.length
            last_seen = _last_seen(to_time, width)
            sends &= (to_time < slab_start) | (last_seen > slab_start + cut.length)
        sent = pd.DataFrame(
            {
                "place": block["to_place"].to_numpy()[sends],
                "time": to_time[sends],
                "value": value[sends],
            }
        )
        sent = sent.groupby(["place", "time"], as_index=False)["value"].max()
        if salt:  # other blocks have points of this slab
            return [sent.assign(settled=False)], None
        inside = pd.DataFrame(
            {
                "settled": True,
                "place": block["place"].to_numpy()[sample][rose],
                "time": time[sample][rose],
                "value": cum[rose],
            }
        )
        told = sent
        if cut.calm:  # the blocks that follow in the zone are all told here
            zone_end = cut.first + (slab - slab % cut.span + cut.span) * cut.length
            told = sent[(sent["time"] < slab_start) | (_last_seen(sent["time"], width) > zone_end)]
        return [inside, told.assign(settled=False)], sent

    return settle_all


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[int, ...], pd.DataFrame]]:
    """The rows of each block, by their zone, salt and slab, from sorted batches."""
    held: list[pd.DataFrame] = []
    last: tuple[int, ...] = ()
    for batch in batches:
        keys = batch[BLOCK].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(batch)] if len(batch) else []
        for low, high in pairwise(bounds):
            own = tuple(keys[low].tolist())
            if held and own != last:
                yield last, pd.concat(held, ignore_index=True)
                held = []
            held.append(batch.iloc[low:high].drop(columns=BLOCK))
            last = own
    if held:
        yield last, pd.concat(held, ignore_index=True)


def _last_seen(times, width: int):
    """The end of the time in which points see an arrival."""
    return (times // MICROS + width) * MICROS


def _in_reach(
    place: np.ndarray, time: np.ndarray, to_place: np.ndarray, to_time: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The arrivals in order of place and time, their keys, and the two keys between which a point sees them."""
    arriving = np.lexsort((to_time, to_place))
    times = np.unique(to_time)

    def key(where: np.ndarray, when: np.ndarray) -> np.ndarray:
        return where * (len(times) + 1) + np.searchsorted(times, when)

    earliest = (time // MICROS - (width - 1)) * MICROS
    return arriving, key(to_place, to_time)[arriving], key(place, earliest), key(place, time)


def _relaxed(
    known: np.ndarray,
    at: np.ndarray,
    place: np.ndarray,
    time: np.ndarray,
    to_place: np.ndarray,
    to_time: np.ndarray,
    weight: np.ndarray,
    width: int,
) -> np.ndarray:
    """Largest sum at each point, given what is known and the legs between the points.

    ``place`` and ``time`` are the points', the others the legs'; ``at`` is the point a
    leg starts from. The points are taken in short stretches of time, each repeated until
    it stands still: a chain of many hops then costs many passes over a stretch, not over
    the block.
    """
    arriving, arrival_key, low_key, high_key = _in_reach(place, time, to_place, to_time, width)
    earliest = (time // MICROS - (width - 1)) * MICROS

    by_time = np.argsort(time, kind="stable")
    arrivals_by_time = np.argsort(to_time[arriving], kind="stable")
    arrival_times = to_time[arriving][arrivals_by_time]

    cum = known.copy()
    for _ in range(len(time) + 1):
        moved = False
        for start in range(0, len(time), STRETCH):
            points = by_time[start : start + STRETCH]
            window = np.searchsorted(
                arrival_times, [earliest[points[0]], time[points[-1]]]
            )
            seen = np.sort(arrivals_by_time[window[0] : window[1]])
            low = np.searchsorted(arrival_key[seen], low_key[points])
            high = np.searchsorted(arrival_key[seen], high_key[points])
            legs = arriving[seen]
            for _ in range(len(points) + 1):
                values = weight[legs] + cum[at[legs]]
                best = np.maximum(cum[points], _range_max(values, low, high))
                if np.array_equal(best, cum[points]):
                    break
                cum[points] = best
                moved = True
            else:
                raise RuntimeError("chains in a block never end; is there a cycle?")
        # only a trip that ends before it starts can reach back to an earlier stretch
        if not moved or (to_time >= time[at]).all():
            return cum
    raise RuntimeError("chains in a block never end; is there a cycle?")


def _range_max(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Maximum of ``values[low:high]`` for each range; 0 for an empty one."""
    size = high - low
    best = np.zeros(len(low))
    level, span = values, 1
    while True:
        fits = (size >= span) & (size < 2 * span)
        best[fits] = np.maximum(level[low[fits]], level[high[fits] - span])
        if not (size >= 2 * span).any():
            return best
        level = np.maximum(level[:-span], level[span:])
        span *= 2
