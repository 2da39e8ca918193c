"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(column: str | Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("timestamp").cast("long")


def epoch_micros(column: str | Column) -> Column:
    """Microseconds since the epoch: the full precision of a Spark timestamp."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def none_null(columns: Iterable[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def money_sum(column: str | Column, scale: int | None = None) -> Column:
    """Sum of a double column.

    With ``scale`` the values are added as decimals of that many places, so the
    result does not depend on how the rows are spread over partitions.
    """
    column = F.col(column) if isinstance(column, str) else column
    if scale is None:
        return F.sum(column)
    return F.sum(column.cast(f"decimal(18,{scale})")).cast("double")
