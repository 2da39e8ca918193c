"""Sorted results and top-k lists with fixed tie rules, and the lookup join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.operators.profile import count_by
from triploom.schema import TRIP_COLUMNS, TripColumns
from triploom.sources.checkpoints import cut_lineage


def ranked(df: DataFrame, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """All rows, largest ``by`` first; equal values in ascending ``ties`` order."""
    return df.orderBy(F.desc(by), *(F.asc(c) for c in ties))


def numbered(df: DataFrame, by: str, ties: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """The rows with their place, from 1, in the order of :func:`ranked`.

    The rows are sorted by ranges, and a partition only needs the number of rows in those
    before it; no task sees the whole table. ``ties`` should settle all ties.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc(by), *(F.asc(c) for c in ties)]
    placed = cut_lineage(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # partitions
    sizes = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    starts = sizes.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    place = (F.col("_at") + F.col("_start") + 1).alias(rank)
    return placed.join(F.broadcast(starts), "_part").select(*df.columns, place)


def top_k(df: DataFrame, by: str, k: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of :func:`ranked`.

    Spark runs this as a top-k per partition and one merge of at most ``k`` rows
    from each, never as a full sort.
    """
    return ranked(df, by, ties).limit(k)


def with_location(
    df: DataFrame,
    locations: DataFrame,
    key: str,
    prefix: str = "",
    columns: Sequence[str] = ("Zone", "Borough"),
) -> DataFrame:
    """Add lookup columns for the location id in ``key``; unknown ids give NULL.

    No join hint: Spark broadcasts the lookup while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond it.
    """
    lookup = locations.select(
        F.col("LocationID").alias("_location"),
        *(F.col(c).alias(f"{prefix}{c}") for c in columns),
    )
    return df.join(lookup, F.col(key) == F.col("_location"), "left").drop("_location")


def top_locations(
    trips: DataFrame, locations: DataFrame, key: str, k: int = 10
) -> DataFrame:
    """The ``k`` most frequent values of a location column, with zone and borough."""
    top = top_k(count_by(trips, key), "count", k, [key])
    return ranked(with_location(top, locations, key), "count", [key])


def top_paths(
    pair_counts: DataFrame,
    locations: DataFrame,
    k: int = 10,
    cols: TripColumns = TRIP_COLUMNS,
) -> DataFrame:
    """The ``k`` most frequent pairs, with zone and borough of both ends.

    Takes the table of :func:`count_by` so that one count can feed several reports.
    """
    top = top_k(pair_counts, "count", k, cols.pair)
    named = with_location(top, locations, cols.pickup_location, "PU_")
    named = with_location(named, locations, cols.dropoff_location, "DO_")
    return ranked(named, "count", cols.pair)
