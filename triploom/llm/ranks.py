"""Row numbers within groups that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.storage import stored


def gapless(df: DataFrame, group: str, order: list[str], rank: str) -> DataFrame:
    """Number the rows of each ``group`` from 0, in the order of ``order``.

    The rows are range-partitioned by group and order, so a large group spreads over many
    partitions; each partition then only needs the number of rows of its groups in the
    partitions before it. That table has a row per partition, and one per group at most.
    ``order`` should settle all ties; rows that still tie are numbered in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *map(F.col, order)]
    placed = stored(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranks",
    )
    before = Window.partitionBy("_group").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in"))
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
        .select("_group", "_in", "_base")
    )
    matches = placed[group].eqNullSafe(offsets["_group"]) & (placed["_part"] == offsets["_in"])
    return placed.join(F.broadcast(offsets), matches).select(
        *[placed[c] for c in df.columns], (F.col("_at") + F.col("_base")).alias(rank)
    )
