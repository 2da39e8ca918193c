"""The registered queries: operators over the trip views of the contract's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.functions import epoch_seconds
from triploom.operators import (
    ForestModel,
    assemble_graph,
    chain_paths,
    chain_text,
    count_by,
    count_rows,
    cycles,
    drop_outliers,
    enrich,
    fit_isolation_forest,
    label_by_contamination,
    longest_chains,
    neighbour_totals,
    numbered,
    outliers,
    pair_totals,
    positive_average,
    prepare,
    rows_with_nulls,
    successor_edges,
    summarize,
    top_k,
    top_locations,
    top_paths,
    totals,
    trip_chains,
    trip_vertices,
    with_location,
    with_trip_id,
)
from triploom.operators.iforest import forest_samples, grow_trees
from triploom.operators.pairs import STRUCT_KEY
from triploom.plans.views import (
    EVENT_MAX_IDLE_S,
    event_trips,
    order_locations,
    order_trips,
)
from triploom.schema import SUMMARY_COLUMNS
from triploom.sources import cut_lineage, ensure_checkpoint_dir, read_trips, write_csv

PAIR = ["PULocationID", "DOLocationID"]
ENRICHED = [*PAIR, "passenger_count", "trip_distance", "total_amount", "trip_duration"]
CONTAMINATION = 0.001

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c, scale in columns.items()})


def _summary(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rounded(summarize(df, columns), {"mean": 4, "stddev": 4})


def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(order_trips(spark, sf_dir), list(SUMMARY_COLUMNS))


def profile_pairs_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(count_by(order_trips(spark, sf_dir), PAIR), [*PAIR, "count"])


def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_with_nulls(order_trips(spark, sf_dir))
    return rows.withColumns(
        {
            "pickup_s": epoch_seconds("tpep_pickup_datetime"),
            "dropoff_s": epoch_seconds("tpep_dropoff_datetime"),
        }
    ).drop("tpep_pickup_datetime", "tpep_dropoff_datetime")


def custom_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(order_trips(spark, sf_dir))


def avg_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive_average(order_trips(spark, sf_dir))


def pickup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(order_trips(spark, sf_dir), "PULocationID")


def dropoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(order_trips(spark, sf_dir), "DOLocationID")


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(order_trips(spark, sf_dir), PAIR)


def pair_counts_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations = order_locations(spark, sf_dir)
    named = with_location(pair_counts(spark, sf_dir), locations, PAIR[0], "PU_")
    return with_location(named, locations, PAIR[1], "DO_")


def top_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, locations = order_trips(spark, sf_dir), order_locations(spark, sf_dir)
    return top_locations(trips, locations, "PULocationID")


def top_dropoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, locations = order_trips(spark, sf_dir), order_locations(spark, sf_dir)
    return top_locations(trips, locations, "DOLocationID")


def top_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_paths(pair_counts(spark, sf_dir), order_locations(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(order_trips(spark, sf_dir)).select(*ENRICHED, "speed")


def enriched_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(order_trips(spark, sf_dir), amounts=True)
    return rows.select(*ENRICHED, "speed", "amount_per_mile", "amount_per_second")


def _feature(position: int) -> Column:
    return vector_to_array("features")[position]


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare(order_trips(spark, sf_dir), "speed_distance")
    return rows.select(
        *ENRICHED,
        F.round(_feature(0), 6).alias("scaled_speed"),
        F.round(_feature(1), 6).alias("scaled_distance"),
    )


def pair_totals_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_totals(order_trips(spark, sf_dir), scale=2)


def pair_totals_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_totals(order_trips(spark, sf_dir), key="struct", scale=2)
    return rows.select(*(F.col(f"`{STRUCT_KEY}`.{c}") for c in PAIR), "total_amount")


def top_pair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(pair_totals_columns(spark, sf_dir), "total_amount", 10, PAIR)


def max_pair_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_totals_columns(spark, sf_dir).agg(
        F.max("total_amount").alias("max_total_amount")
    )


def neighbour_totals_depth(depth: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = neighbour_totals(order_trips(spark, sf_dir), depth, scale=2)
        return _rounded(rows, {"cumulated_total_amount": 2})

    return query


def top_neighbour_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neighbour_totals_depth(1)(spark, sf_dir)
    return top_k(rows, "cumulated_total_amount", 10, PAIR)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(order_trips(spark, sf_dir)).select(*ENRICHED, "speed")
    return label_by_contamination(rows, "speed", CONTAMINATION)


def threshold_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)


def outlier_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(outliers(_labelled(spark, sf_dir)), "outliers")


def clean_top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_outliers(_labelled(spark, sf_dir))
    return top_k(pair_totals(cleaned, scale=2), "total_amount", 10, PAIR)


def _forest(spark: SparkSession, sf_dir: str, features: str) -> tuple[DataFrame, ForestModel]:
    rows = prepare(event_trips(spark, sf_dir), features)
    return rows, fit_isolation_forest(rows, id_col="tripId", contamination=CONTAMINATION)


def forest_outliers(features: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, model = _forest(spark, sf_dir, features)
        columns = ["tripId", *PAIR, "trip_distance", "trip_duration", "speed"]
        found = outliers(model.transform(rows)).select(*columns, "outlierScore", "predictedLabel")
        return _rounded(found, {"outlierScore": 9})

    return query


def iforest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _forest(spark, sf_dir, "speed")
    scored = model.transform(rows).select("tripId", "outlierScore", "predictedLabel")
    return _rounded(scored, {"outlierScore": 9})


def iforest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare(event_trips(spark, sf_dir), "speed_distance")
    samples = forest_samples(rows, id_col="tripId")
    nodes = grow_trees(samples, width=2, max_depth=8, seed=1).drop("left", "right")
    return _rounded(nodes, {"split": 9})


def _event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return successor_edges(event_trips(spark, sf_dir), EVENT_MAX_IDLE_S)


def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph whose vertex table lacks the trips without a distance; edges name some."""
    known = event_trips(spark, sf_dir).filter("trip_distance is not null")
    return assemble_graph(trip_vertices(known), _event_edges(spark, sf_dir))


def graph_chains(weight: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        vertices = trip_vertices(event_trips(spark, sf_dir))
        return longest_chains(vertices, _event_edges(spark, sf_dir), weight)

    return query


def direct_chains(weight: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return trip_chains(event_trips(spark, sf_dir), EVENT_MAX_IDLE_S, weight)

    return query


def chains_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains by trips whose edges carry a weight of their own: a trip lost for every two hours of waiting."""
    trips = event_trips(spark, sf_dir)
    ends = trips.select(F.col("tripId").alias("src"), epoch_seconds("tpep_dropoff_datetime").alias("ended"))
    starts = trips.select(F.col("tripId").alias("dst"), epoch_seconds("tpep_pickup_datetime").alias("began"))
    edges = _event_edges(spark, sf_dir).join(ends, "src").join(starts, "dst")
    lost = -F.floor((F.col("began") - F.col("ended")) / 7200).cast("double")
    edges = edges.select("src", "dst", lost.alias("nb"))
    return longest_chains(trip_vertices(trips), edges, "count", edge_weight="nb")


def place_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places on a round trip of trips that end before they start: only such can close a chain."""
    trips = event_trips(spark, sf_dir).filter("tpep_dropoff_datetime < tpep_pickup_datetime")
    edges = trips.select(F.col("PULocationID").alias("src"), F.col("DOLocationID").alias("dst"))
    return cycles(edges).withColumnRenamed("tripID", "place")


def file_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip ids from the order of the file."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return with_trip_id(events).select("event_id", "tripId")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips written as CSV to the shared folder and read back by the fixed schema."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/csv-{uuid.uuid4().hex}"
    write_csv(order_trips(spark, sf_dir), path)
    times = {"pickup_s": epoch_seconds("tpep_pickup_datetime"), "dropoff_s": epoch_seconds("tpep_dropoff_datetime")}
    rows = read_trips(spark, path).withColumns(times)
    return rows.drop("tpep_pickup_datetime", "tpep_dropoff_datetime")


def ranked_pair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(pair_totals_columns(spark, sf_dir), "total_amount", PAIR)


def ranked_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(direct_chains("distance")(spark, sf_dir), "longestDistance", ["tripID"])


def chain_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = cut_lineage(direct_chains("distance")(spark, sf_dir))
    return chain_text(chain_paths(chains, k=3))


QUERIES: dict[str, Query] = {
    "profile_describe": profile_describe,
    "profile_pairs_describe": profile_pairs_describe,
    "null_rows": null_rows,
    "custom_totals": custom_totals,
    "avg_positive": avg_positive,
    "pickup_counts": pickup_counts,
    "dropoff_counts": dropoff_counts,
    "pair_counts": pair_counts,
    "pair_counts_named": pair_counts_named,
    "top_pickups": top_pickups,
    "top_dropoffs": top_dropoffs,
    "top_paths": top_pair_counts,
    "enriched": enriched,
    "enriched_amounts": enriched_amounts,
    "scaled_features": scaled_features,
    "pair_totals": pair_totals_columns,
    "pair_totals_struct": pair_totals_struct,
    "top_pair_totals": top_pair_totals,
    "max_pair_total": max_pair_total,
    "neighbour_totals_d1": neighbour_totals_depth(1),
    "neighbour_totals_d2": neighbour_totals_depth(2),
    "neighbour_totals_d15": neighbour_totals_depth(15),
    "top_neighbour_totals": top_neighbour_totals,
    "threshold_labels": threshold_labels,
    "outlier_count": outlier_count,
    "clean_top_pairs": clean_top_pairs,
    "outliers_iforest": forest_outliers("speed"),
    "outliers_iforest_two_features": forest_outliers("speed_distance"),
    "iforest_scores": iforest_scores,
    "iforest_nodes": iforest_nodes,
    "successor_edges": _event_edges,
    "graph_vertices": graph_vertices,
    "chains_distance": graph_chains("distance"),
    "chains_trips": graph_chains("count"),
    "trip_chains_distance": direct_chains("distance"),
    "trip_chains_trips": direct_chains("count"),
    "chains_waiting": chains_waiting,
    "place_cycles": place_cycles,
    "file_row_ids": file_row_ids,
    "csv_round_trip": csv_round_trip,
    "ranked_pair_totals": ranked_pair_totals,
    "ranked_chains": ranked_chains,
    "chain_path": chain_path,
}
