"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.sources.checkpoints import shared_base

BROADCAST_BYTES = 16 << 20
BATCH_ROWS = 2_000
ROOT = str(Path(__file__).resolve().parents[2])


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it.

    That is enough where they share a disk; other clusters get it with ``--py-files``.
    Arrow batches of Spark's usual size are made smaller, as texts are long.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run: below spark.checkpoint.dir, or below the warehouse if unset."""
    return f"{shared_base(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut.

    What a lost executor held can be read again from there by any other.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path behind ``uri``, the folder made if missing; works in any task."""
    files, path = pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", ""))
    files.create_dir(path, recursive=True)
    return files, path


def small(df: DataFrame, row_bytes: int) -> bool:
    """Whether ``df``, counted, is surely below the size that may be broadcast."""
    return df.limit(BROADCAST_BYTES // row_bytes + 1).count() <= BROADCAST_BYTES // row_bytes


def only(docs: DataFrame, ids: DataFrame, how: str, key: str | list[str] = "doc_id") -> DataFrame:
    """Semi or anti join by ``key``; ``docs`` isn't shuffled if the ids surely fit a broadcast."""
    return docs.join(F.broadcast(ids) if small(ids, 64) else ids, key, how)
