"""From raw documents to token files, stage by stage.

Each stage takes the documents that its predecessor kept, as read back from Parquet, and
calls one operator of ``triploom.llm`` on all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from triploom.llm import decontaminate, huffman, mixing, quality, simhash_dups
from triploom.llm.queries import DOMAINS, WEIGHTS
from triploom.llm.storage import reach_workers, stored

#: Few, as the workers of the stages before still hold memory when the last one starts.
CACHED_PIECES = 150_000


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the scorer trained on weak labels accepts."""
    reach_workers(spark)
    return quality.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by fingerprints: that of the smallest doc_id.

    Rows without a doc_id and rows that share one are decided by their texts like any other.
    """
    reach_workers(spark)
    return simhash_dups.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    reach_workers(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that the domains have their target shares of all words."""
    reach_workers(spark)
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), DOMAINS, WEIGHTS)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; per document what is read back from them."""
    reach_workers(spark)
    return huffman.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), cached=CACHED_PIECES, keep=False)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
    ("token-ID output", write_ids),
]

#: No SQL can express the classifiers and the token files.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    reach_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
