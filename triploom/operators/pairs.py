"""Amounts per (pickup, drop-off) pair, alone or with the neighbouring pairs."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triploom.functions import money_sum
from triploom.schema import TRIP_COLUMNS, TripColumns

# executors get the functions below with the task and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRUCT_KEY = "[PULocationID,DOLocationID]"
BLOCK_IDS = 512
#: Up to here the table of a square, of at most (4 * depth) squared sums, surely fits a task.
MOST_DEPTH = 1_000


def pair_totals(
    df: DataFrame,
    value: str = "total_amount",
    key: str = "columns",
    scale: int | None = None,
    cols: TripColumns = TRIP_COLUMNS,
) -> DataFrame:
    """Sum of ``value`` per pair; NULL ids are keys, NULL amounts are ignored.

    ``key="columns"`` keeps the two id columns, ``key="struct"`` gives them as one
    struct column. Rows are summed inside each input partition before the shuffle,
    so a hot pair costs one row per partition. ``scale`` adds as decimals.
    """
    totals = df.groupBy(*cols.pair).agg(money_sum(value, scale).alias(value))
    if key == "columns":
        return totals
    if key == "struct":
        return totals.select(F.struct(*cols.pair).alias(STRUCT_KEY), value)
    raise ValueError(f"unknown key {key!r}; use 'columns' or 'struct'")


def neighbour_totals(
    df: DataFrame,
    depth: int = 1,
    value: str = "total_amount",
    scale: int | None = None,
    cols: TripColumns = TRIP_COLUMNS,
    block: int = BLOCK_IDS,
) -> DataFrame:
    """Each pair's total plus the totals of all pairs at most ``depth`` ids away.

    Only pairs present in the data are returned. A pair whose own total is NULL
    stays NULL, and a pair with a NULL id has no neighbours.

    With ``scale`` the totals are whole multiples of its last place, whose sums are exact in
    any order. Then the pairs are dealt to squares of ``block`` ids a side, with copies of
    those near a border, and each square answers from a summed-area table: four corners per
    pair, so neither rows nor work grow with the depth. Deeper than ``MOST_DEPTH``, and for
    plain doubles, the square is summed one axis after the other instead.
    """
    if depth < 0:
        raise ValueError("depth must not be negative")
    pickup, dropoff = cols.pair
    amount = F.col(value) if scale is None else F.col(value).cast(f"decimal(18,{scale})")
    totals = df.groupBy(*cols.pair).agg(F.sum(amount).alias("amount")).select(
        F.col(pickup).cast("long").alias("pu"), F.col(dropoff).cast("long").alias("do"), "amount"
    )
    if scale is None or depth > MOST_DEPTH:
        found = _axis_by_axis(totals, depth)
    else:
        found = _by_squares(totals, depth, scale, max(block, 2 * depth))
    return found.select(
        F.col("pu").cast(df.schema[pickup].dataType).alias(pickup),
        F.col("do").cast(df.schema[dropoff].dataType).alias(dropoff),
        F.col("amount").cast("double").alias(f"cumulated_{value}"),
    )


def with_halo(totals: DataFrame, depth: int, width: int) -> DataFrame:
    """``totals`` dealt to squares ``(bx, by)`` of ``width`` ids; ``own`` marks the square a pair lies in.

    A pair within ``depth`` of a border is in the squares beyond it too: four at most.
    """

    def squares(column: str) -> Column:
        sides = (F.floor((F.col(column) + step) / width) for step in (-depth, depth))
        return F.explode(F.array_distinct(F.array(*sides)))

    own = (F.col("bx") == F.floor(F.col("pu") / width)) & (F.col("by") == F.floor(F.col("do") / width))
    return totals.withColumn("bx", squares("pu")).withColumn("by", squares("do")).withColumn("own", own)


def _by_squares(totals: DataFrame, depth: int, scale: int, width: int) -> DataFrame:
    placed = F.col("pu").isNotNull() & F.col("do").isNotNull()
    units = (F.col("amount") * 10**scale).cast("long").alias("amount")
    halo = with_halo(totals.filter(placed).select("pu", "do", units), depth, width)
    summed = halo.groupBy("bx", "by").applyInPandas(_square_sums(depth), "pu long, do long, amount long")
    summed = summed.select("pu", "do", (F.col("amount") / float(10**scale)).alias("amount"))
    return summed.unionAll(totals.filter(~placed).select("pu", "do", F.col("amount").cast("double")))


def _square_sums(depth: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def sums(square: pd.DataFrame) -> pd.DataFrame:
        pu, do = square["pu"].to_numpy(), square["do"].to_numpy()
        (xs, x), (ys, y) = (np.unique(ids, return_inverse=True) for ids in (pu, do))
        table = np.zeros((len(xs) + 1, len(ys) + 1), np.int64)
        np.add.at(table, (x + 1, y + 1), square["amount"].fillna(0).to_numpy(np.int64))
        table = table.cumsum(axis=0).cumsum(axis=1)
        own = square["own"].to_numpy(bool)
        west, east = (np.searchsorted(xs, pu[own] + d, s) for d, s in ((-depth, "left"), (depth, "right")))
        south, north = (np.searchsorted(ys, do[own] + d, s) for d, s in ((-depth, "left"), (depth, "right")))
        around = table[east, north] - table[west, north] - table[east, south] + table[west, south]
        amount = pd.Series(around, dtype="Int64").mask(square["amount"][own].isna().to_numpy())
        return pd.DataFrame({"pu": pu[own], "do": do[own], "amount": amount})

    return sums


def _axis_by_axis(totals: DataFrame, depth: int) -> DataFrame:
    """``2 * depth + 1`` copies of each pair, one per drop-off in reach, are summed per cell, and
    a window over the pickups in reach adds up the cells of a drop-off.

    Rows grow with the depth and not with its square. A window holds one drop-off: at most
    one row per pickup id, whatever the number of trips.
    """
    placed = F.col("pu").isNotNull() & F.col("do").isNotNull()
    steps = F.when(placed, F.sequence(F.lit(-depth), F.lit(depth))).otherwise(F.array(F.lit(0)))
    own = F.when(F.col("step") == 0, F.col("amount"))
    cells = (
        totals.withColumn("step", F.explode(steps))
        .select("pu", (F.col("do") + F.col("step")).alias("do"), "step", "amount")
        .repartition("do")
        .groupBy("pu", "do")
        .agg(F.max(F.col("step") == 0).alias("present"), F.max(own).alias("own"), F.sum("amount").alias("amount"))
    )
    lane = ["do", F.when(F.col("do").isNull(), F.col("pu"))]  # a NULL id has no neighbours
    near = Window.partitionBy(*lane).orderBy("pu").rangeBetween(-depth, depth)
    summed = cells.withColumn("around", F.sum("amount").over(near)).filter("present")
    return summed.select("pu", "do", F.when(F.col("own").isNotNull(), F.col("around")).alias("amount"))
