"""Running maxima over groups that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.sources.checkpoints import cut_lineage


def running_max(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "best"
) -> DataFrame:
    """``rows`` with ``name``, the largest ``value`` of the same ``keys`` up to each row.

    The rows are dealt out by ranges of keys and ``order``, so a large group spreads over
    as many tasks as it needs. A task finds the maxima inside its piece; the maximum of each
    piece goes to the later pieces of the same group, a table with at most two rows per task.
    NULL values count for nothing; rows that tie in ``order`` may see each other or not, so
    ``order`` should settle what matters.
    """
    keys, order = list(keys), list(order)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        rows.repartitionByRange(parts, *keys, *order).withColumn("_piece", F.spark_partition_id())
    )
    pieces = placed.groupBy(*keys, "_piece").agg(F.max(value).alias("_most"))
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    brought = (
        pieces.withColumns({"_n": F.count("*").over(by_key), "_before": F.max("_most").over(earlier)})
        .filter("_n > 1 and _before is not null")
        .select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_piece").alias("_in"), "_before")
    )
    inside = Window.partitionBy("_piece", *keys).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn("_inside", F.max(value).over(inside))
    same = F.col("_piece") == F.col("_in")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return found.join(F.broadcast(brought), same, "left").select(
        *(placed[c] for c in rows.columns), F.greatest("_inside", "_before").alias(name)
    )
