"""The profile and chain reports: named result tables from one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from triploom.operators import (
    chain_paths,
    chain_text,
    count_by,
    positive_average,
    ranked,
    rows_with_nulls,
    summarize,
    top_locations,
    top_paths,
    totals,
    trip_chains,
)
from triploom.schema import SUMMARY_COLUMNS, TRIP_COLUMNS
from triploom.sources import cut_lineage


def profile_report(
    trips: DataFrame, locations: DataFrame, k: int = 10
) -> dict[str, DataFrame]:
    """Profile of a trips table. Every entry is a query of its own over ``trips``, so
    persist the table first when all of them are wanted and it fits."""
    pairs = cut_lineage(count_by(trips, TRIP_COLUMNS.pair))  # read by two of the tables
    return {
        "summary": summarize(trips, SUMMARY_COLUMNS),
        "rows_with_nulls": rows_with_nulls(trips),
        "totals": totals(trips),
        "average_passengers": positive_average(trips),
        "top_pickups": top_locations(trips, locations, TRIP_COLUMNS.pickup_location, k),
        "top_dropoffs": top_locations(trips, locations, TRIP_COLUMNS.dropoff_location, k),
        "top_paths": top_paths(pairs, locations, k),
        "pair_summary": summarize(pairs),
    }


def chain_report(
    trips: DataFrame,
    max_idle_s: float = 300,
    weights: Sequence[str] = ("distance",),
    k: int = 1,
) -> dict[str, DataFrame]:
    """Per weight, all trips ranked by the chain that ends with them, and the trips of
    the ``k`` heaviest chains as text. ``trips`` needs a trip id."""
    report = {}
    for weight in weights:
        chains = cut_lineage(trip_chains(trips, max_idle_s, weight))
        report[f"chains_{weight}"] = ranked(chains, "longestDistance", ["tripID"])
        report[f"path_{weight}"] = chain_text(chain_paths(chains, k))
    return report
