"""Profile of a trips table: summaries, NULL rows, totals, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from triploom.functions import any_null
from triploom.schema import NULL_CHECK_COLUMNS


def summarize(
    df: DataFrame, columns: Sequence[str] | None = None, layout: str = "long"
) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column.

    ``layout="long"`` gives one typed row per numeric column, from a single
    aggregation pass; ``layout="describe"`` gives Spark's own table of strings,
    which also takes text columns.
    """
    if layout == "describe":
        return df.describe(*(columns or ()))
    if layout != "long":
        raise ValueError(f"unknown layout {layout!r}; use 'long' or 'describe'")
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    chosen = list(columns) if columns is not None else numeric
    if other := [c for c in chosen if c not in numeric]:
        raise ValueError(f"not numeric: {other}; use layout='describe'")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).cast("double").alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in chosen
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def totals(
    df: DataFrame, columns: Sequence[str] = ("total_amount", "trip_distance"), scale: int = 2
) -> DataFrame:
    """One row of column sums, rounded half up."""
    return df.agg(*(F.round(F.sum(c), scale).alias(f"total_{c}") for c in columns))


def positive_average(
    df: DataFrame, column: str = "passenger_count", scale: int = 2
) -> DataFrame:
    """Rounded mean of the values above zero; NULL and zero mean "not filled in"."""
    return df.filter(F.col(column) > 0).agg(
        F.round(F.avg(column), scale).alias(f"average_{column}")
    )


def rows_with_nulls(
    df: DataFrame, columns: Sequence[str] = NULL_CHECK_COLUMNS
) -> DataFrame:
    """Rows in which any of the columns is NULL."""
    return df.filter(any_null(columns))


def count_by(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows per key; NULL keys form a group of their own."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """Number of rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(name))

