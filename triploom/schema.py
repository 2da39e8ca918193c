"""Fixed schemas and column names of the trip data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The published column names and types of the trips file.
TRIPS_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

# The published column names and types of the location lookup.
LOCATIONS_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# The columns the profile summarises and scans for NULLs.
SUMMARY_COLUMNS = (
    "passenger_count",
    "trip_distance",
    "total_amount",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
)
NULL_CHECK_COLUMNS = ("VendorID", *SUMMARY_COLUMNS)


@dataclass(frozen=True)
class TripColumns:
    """Names of the columns the operators read; override for other tables."""

    trip_id: str = "tripId"
    pickup_time: str = "tpep_pickup_datetime"
    dropoff_time: str = "tpep_dropoff_datetime"
    pickup_location: str = "PULocationID"
    dropoff_location: str = "DOLocationID"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    amount: str = "total_amount"

    @property
    def pair(self) -> tuple[str, str]:
        return self.pickup_location, self.dropoff_location


TRIP_COLUMNS = TripColumns()
