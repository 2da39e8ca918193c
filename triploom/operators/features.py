"""Derived trip columns and the scaled feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.functions import epoch_seconds
from triploom.schema import TRIP_COLUMNS, TripColumns

# The named feature sets.
FEATURE_SETS = {
    "speed": ("speed",),
    "speed_distance": ("speed", "trip_distance"),
    "amounts": ("speed", "amount_per_mile", "amount_per_second"),
}


def enrich(
    trips: DataFrame, cols: TripColumns = TRIP_COLUMNS, amounts: bool = False
) -> DataFrame:
    """Add ``trip_duration`` in whole seconds and ``speed`` in miles per second.

    Drops rows without a distance or without a positive duration; zero and negative
    distances stay. With ``amounts`` the rows must also have a positive distance and
    fare, and get ``amount_per_mile`` and ``amount_per_second``.
    """
    duration = epoch_seconds(cols.dropoff_time) - epoch_seconds(cols.pickup_time)
    kept = trips.filter(F.col(cols.distance).isNotNull())
    if amounts:
        kept = kept.filter((F.col(cols.distance) > 0) & (F.col(cols.fare) > 0))
    kept = kept.withColumn("trip_duration", duration).filter(F.col("trip_duration") > 0)
    # try_divide, because the optimizer may evaluate the division before the filter
    speed = F.try_divide(F.col(cols.distance), F.col("trip_duration"))
    if not amounts:
        return kept.withColumn("speed", speed)
    return kept.withColumns(
        {
            "speed": speed,
            "amount_per_mile": F.try_divide(F.col(cols.fare), F.col(cols.distance)),
            "amount_per_second": F.try_divide(F.col(cols.fare), F.col("trip_duration")),
        }
    )


def assemble_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combine the feature columns into one vector column ``features``."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def scale_features(df: DataFrame) -> DataFrame:
    """Divide every feature by its sample standard deviation, without centring."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled")
    scaled = scaler.fit(df.select("features")).transform(df)
    return scaled.drop("features").withColumnRenamed("scaled", "features")


def feature_columns(features: str | Sequence[str]) -> tuple[str, ...]:
    """Resolve the name of a feature set, or take the column names as given."""
    if isinstance(features, str):
        if features not in FEATURE_SETS:
            raise ValueError(f"unknown feature set {features!r}")
        return FEATURE_SETS[features]
    return tuple(features)


def prepare(
    trips: DataFrame,
    features: str | Sequence[str] = "speed",
    cols: TripColumns = TRIP_COLUMNS,
) -> DataFrame:
    """Enriched trips with their scaled ``features`` vector."""
    columns = feature_columns(features)
    amounts = bool({"amount_per_mile", "amount_per_second"} & set(columns))
    return scale_features(assemble_features(enrich(trips, cols, amounts), columns))
