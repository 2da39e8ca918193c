"""Trip-shaped views over the TPC-H-like tables of the query contract.

``order_trips`` reads line items as trips between the supplier's and the customer's
nation; ``event_trips`` reads events as short trips between user ids. Each has the same
definition in SQL, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only the columns the views use. The files hold times without a zone; reading them as
# Spark timestamps takes them as UTC instants whatever the session's time zone.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey long, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp",
    "lineitem": (
        "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp"
    ),
    "events": "event_id long, ts timestamp, user_id long, value double",
}

# Idle limit for the event trips, in seconds.
EVENT_MAX_IDLE_S = 21600

ORDER_TRIP_COLUMNS = {
    "VendorID": (
        "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 "
        "WHEN l_tax < 0.08 THEN 4 END"
    ),
    "tpep_pickup_datetime": "o_orderdate",
    "tpep_dropoff_datetime": "l_shipdate",
    "passenger_count": (
        "CASE WHEN l_returnflag <> 'R' OR l_tax < 0.08 THEN l_linenumber - 1 END"
    ),
    "trip_distance": "l_quantity",
    "RatecodeID": "l_linenumber",
    "store_and_fwd_flag": "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END",
    "PULocationID": "s_nationkey",
    "DOLocationID": "c_nationkey",
    "payment_type": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END",
    "fare_amount": "o_totalprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "c_acctbal",
    "tolls_amount": "s_acctbal",
    "improvement_surcharge": "CAST(0.3 AS DOUBLE)",
    "total_amount": "l_extendedprice",
    "congestion_surcharge": "l_tax",
}

ORDER_TRIPS_SQL = "SELECT {} FROM lineitem {}".format(
    ", ".join(f"{expr} AS {name}" for name, expr in ORDER_TRIP_COLUMNS.items()),
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN supplier ON l_suppkey = s_suppkey",
)

LOCATIONS_SQL = (
    "SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, "
    "r_name AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey"
)

EVENT_TRIPS_SQL = (
    "SELECT event_id AS tripId, "
    "CASE WHEN event_id % 89 <> 3 THEN ts END AS tpep_pickup_datetime, "
    "CASE WHEN event_id % 83 <> 7 THEN ts + to_seconds("
    "CASE WHEN event_id % 101 = 11 THEN -60 ELSE 60 + (event_id * 37) % 1200 END) END "
    "AS tpep_dropoff_datetime, "
    "user_id AS PULocationID, "
    "(user_id + event_id * 13) % (SELECT max(user_id) + 1 FROM events) AS DOLocationID, "
    "CASE WHEN event_id % 97 <> 5 THEN value END AS trip_distance FROM events"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips. Spark picks the join strategy from the table sizes."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    return joined.select(
        *(F.expr(expr).alias(name) for name, expr in ORDER_TRIP_COLUMNS.items())
    )


def order_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips that start at their user's id.

    Some lack a distance or a time, and some end before they start.
    """
    events = table(spark, sf_dir, "events")
    places = events.agg(F.max("user_id") + 1).scalar()
    number = F.col("event_id")
    seconds = F.when(number % 101 == 11, -60).otherwise(60 + number * 37 % 1200)
    dropoff = F.timestamp_micros(F.unix_micros("ts") + seconds * 1_000_000)
    return events.select(
        F.col("event_id").alias("tripId"),
        F.when(number % 89 != 3, F.col("ts")).alias("tpep_pickup_datetime"),
        F.when(number % 83 != 7, dropoff).alias("tpep_dropoff_datetime"),
        F.col("user_id").alias("PULocationID"),
        ((F.col("user_id") + F.col("event_id") * 13) % places).alias("DOLocationID"),
        F.when(number % 97 != 5, F.col("value")).alias("trip_distance"),
    )
