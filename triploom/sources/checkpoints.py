"""Reliable lineage cuts for the iterative operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of the warehouse.

    A warehouse on the driver's own disk is no place for executors elsewhere, so unless Spark
    runs locally that raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = warehouse.startswith("file:") or "://" not in warehouse
    if own_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder for checkpoints, unless one has been set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
