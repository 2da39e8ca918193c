"""Sinks: graph tables and trips as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write CSV with a header; ``single_file`` is for small graph fixtures only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=True)
