"""Stage outputs that are whole or absent: versioned folders and a manifest.

``path/data-...`` holds one version each, ``path/manifest`` a row per finished one. The row
is written after the data, so a job that dies leaves the version before it in force.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, folder string, digest string, written timestamp"
KEPT_VERSIONS = 2


def write_stage(df: DataFrame, path: str, digest: str | None = None) -> None:
    """Replace a stage's output by a new version, which counts once it is whole.

    ``digest`` says what it was made from, for ``is_current``. The version before stays for
    readers that have begun; older ones are removed.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    version = max((v["version"] for v in versions), default=0) + 1
    row = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.lit(folder).alias("folder"),
        F.lit(digest).cast("string").alias("digest"),
        F.current_timestamp().alias("written"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    for old in versions[: 1 - KEPT_VERSIONS or None]:
        _remove(spark, f"{path}/{old['folder']}")


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a stage's output; a folder without a manifest is read as it is."""
    versions = _versions(spark, path)
    return spark.read.parquet(f"{path}/{versions[-1]['folder']}" if versions else path)


def is_current(spark: SparkSession, path: str, digest: str) -> bool:
    """Whether the newest version was made from what ``digest`` stands for."""
    versions = _versions(spark, path)
    return bool(versions) and versions[-1]["digest"] == digest


def stage_digest(spark: SparkSession, path: str) -> str:
    """Names the newest version of a stage, or the files below ``path`` by name, length and time."""
    versions = _versions(spark, path)
    if versions:
        return versions[-1]["folder"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # the content is a column that isn't read
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return digest_of(*files.agg(F.count(F.lit(1)), F.sum(one)).first())


def digest_of(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def _versions(spark: SparkSession, path: str) -> list[Row]:
    """The rows of the manifest, oldest first: a row per time that the stage was run."""
    try:
        manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException:
        return []
    return manifest.orderBy("version", "written", "folder").collect()


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
