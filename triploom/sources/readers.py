"""Scans: trips, locations and graph tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from triploom.schema import LOCATIONS_SCHEMA, TRIPS_SCHEMA
from triploom.sources.stages import read_stage


def _read(
    spark: SparkSession, path: str, schema: StructType, fmt: str, infer: bool
) -> DataFrame:
    if fmt == "parquet":
        return read_stage(spark, path)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}; use 'csv' or 'parquet'")
    reader = spark.read.option("header", True).option("sep", ",")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    found = {name.lstrip("\ufeff").strip(): name for name in text.columns}
    if missing := [name for name in schema.names if name not in found]:
        raise ValueError(f"{path} has no columns {missing}; it has {sorted(found)}")
    return text.select(*(_typed(f"`{found[f.name]}`", f) for f in schema.fields))


def _typed(source: str, field: StructField) -> Column:
    """The text column in the field's type; a value that doesn't fit it fails the query."""
    text = F.col(source)
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, IntegralType):  # whole numbers may be written as 1.0
        whole = text.try_cast("double")
        value = F.coalesce(value, F.when(whole == F.floor(whole), whole.try_cast(field.dataType)))
    message = F.concat(F.lit(f"{field.name} is not a {field.dataType.simpleString()}: "), text)
    # each text is parsed once: only one that gives no value is looked at again
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(field.dataType))).alias(field.name)


def read_trips(
    spark: SparkSession, path: str, fmt: str = "csv", infer: bool = False
) -> DataFrame:
    """Trips table. CSV columns are found by their header names; others are left out.

    The fixed schema saves the extra scan that inference needs. A missing column raises,
    and so does, when the rows are read, a value that is not of the column's type.
    """
    return _read(spark, path, TRIPS_SCHEMA, fmt, infer)


def read_locations(
    spark: SparkSession, path: str, fmt: str = "csv", infer: bool = False
) -> DataFrame:
    """Location lookup: ``LocationID, Borough, Zone, service_zone``."""
    return _read(spark, path, LOCATIONS_SCHEMA, fmt, infer)


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    """Graph vertices: the file's first two columns as ``(tripId, weight)``."""
    raw = spark.read.csv(path, header=True)
    trip, weight = raw.columns[:2]
    return raw.select(
        F.col(trip).cast("long").alias("tripId"),
        F.col(weight).cast("double").alias("weight"),
    )


def read_edges(spark: SparkSession, path: str, attribute: str | None = None) -> DataFrame:
    """Graph edges: the file's first two columns as ``(src, dst)``.

    ``attribute`` keeps the third column under that name, as a double:
    ``longest_chains(edge_weight=attribute)`` adds it along the chain. Without a name it
    stays out of the scan.
    """
    raw = spark.read.csv(path, header=True)
    if attribute and len(raw.columns) < 3:
        raise ValueError(f"{path} has no third column")
    ends = [F.col(c).cast("long") for c in raw.columns[:2]]
    columns = [ends[0].alias("src"), ends[1].alias("dst")]
    if attribute:
        columns.append(F.col(raw.columns[2]).cast("double").alias(attribute))
    return raw.select(*columns)
