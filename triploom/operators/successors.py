"""Which trip can follow which: the interval self-join behind the chains."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.functions import epoch_micros
from triploom.operators.skew import HOT_ROWS, split_hot_keys
from triploom.schema import TRIP_COLUMNS, TripColumns

MICROS = 1_000_000


def idle_window(max_idle_s: float) -> int:
    """Number of whole-second gaps 0, 1, ... that are below the idle limit."""
    if not max_idle_s > 0:
        raise ValueError("max_idle_s must be positive")
    return math.ceil(max_idle_s)


def trip_table(
    trips: DataFrame, invalid_trips: str = "isolate", cols: TripColumns = TRIP_COLUMNS
) -> DataFrame:
    """``(id, pu, do, pickup, dropoff, distance)`` with times in microseconds.

    ``invalid_trips="isolate"`` takes the places away from trips that end before their
    start; they could otherwise follow themselves. ``"keep"`` leaves them. A trip with an
    unknown time keeps its places: it is linked by the time that is known.
    """
    if invalid_trips not in ("isolate", "keep"):
        raise ValueError(f"unknown invalid_trips {invalid_trips!r}")
    pickup, dropoff = epoch_micros(cols.pickup_time), epoch_micros(cols.dropoff_time)
    in_order = F.coalesce(dropoff >= pickup, F.lit(True))
    linked = F.lit(True) if invalid_trips == "keep" else in_order
    return trips.select(
        F.col(cols.trip_id).cast("long").alias("id"),
        F.when(linked, F.col(cols.pickup_location)).alias("pu"),
        F.when(linked, F.col(cols.dropoff_location)).alias("do"),
        pickup.alias("pickup"),
        dropoff.alias("dropoff"),
        F.col(cols.distance).cast("double").alias("distance"),
    )


def slot_of(micros: str, width: int):
    """Start second of the time slot of ``width`` seconds that holds the time."""
    seconds = seconds_of(micros)
    return seconds - F.pmod(seconds, F.lit(width))


def seconds_of(micros: str):
    """Whole seconds of a time in microseconds, rounded down, in integers only."""
    return F.expr(f"({micros} - pmod({micros}, {MICROS})) div {MICROS}")


def successor_edges(
    trips: DataFrame,
    max_idle_s: float = 300,
    invalid_trips: str = "isolate",
    hot_rows: int = HOT_ROWS,
    cols: TripColumns = TRIP_COLUMNS,
) -> DataFrame:
    """Edges ``(src, dst)``: trip ``dst`` starts where and soon after ``src`` ended.

    Both tests of the idle time are strict: the drop-off lies before the pickup, and
    the gap in whole seconds is below ``max_idle_s``.

    Time is cut into slots as long as the idle limit, so a drop-off only meets pickups
    of its own and the next slot at its place. Cells (place, slot) with more than
    ``hot_rows`` rows on a side are cut into a grid of salted sub-cells.
    """
    width = idle_window(max_idle_s)
    table = trip_table(trips, invalid_trips, cols)
    own_slot = slot_of("dropoff", width)
    ends = table.filter("do is not null and dropoff is not null").select(
        F.col("id").alias("src"),
        F.col("do").alias("place"),
        F.explode(F.array(own_slot, own_slot + width)).alias("slot"),
        "dropoff",
    )
    starts = table.filter("pu is not null and pickup is not null").select(
        F.col("id").alias("dst"),
        F.col("pu").alias("place"),
        slot_of("pickup", width).alias("slot"),
        "pickup",
    )
    cell = ["place", "slot"]
    ends, spread_starts, end_keys = split_hot_keys(ends, cell, "src", "end_salt", hot_rows)
    starts, spread_ends, keys = split_hot_keys(starts, cell, "dst", "start_salt", hot_rows)
    ends, starts = spread_ends(ends), spread_starts(starts)
    keys = keys + [k for k in end_keys if k not in keys]
    gap = seconds_of("pickup") - seconds_of("dropoff")
    return (
        ends.join(starts, keys)
        .filter((F.col("dropoff") < F.col("pickup")) & (gap < width))
        .select("src", "dst")
    )
