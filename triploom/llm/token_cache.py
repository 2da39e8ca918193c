"""Token counts through a cache keyed by digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.llm.storage import stored

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens long"
AT_ONCE = 64


@lru_cache(maxsize=4)
def _processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokenizer_version(path: str) -> str:
    """The digest of the vocabulary file and of the library that reads it."""
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read())
    content.update(sentencepiece.__version__.encode())
    return content.hexdigest()


def normalised(text: Column) -> Column:
    """What is counted: the text itself, a NULL as the empty text.

    Any further change (case, white space, composed letters) could change the count.
    """
    return F.coalesce(text, F.lit(""))


def _counter(path: str, version: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _processor(path).encode
        for batch in batches:
            texts = batch.column("text")
            counts = []
            for start in range(0, len(texts), AT_ONCE):
                part = texts.slice(start, AT_ONCE).to_pylist()
                counts += map(len, encode(part, num_threads=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                names=["digest", "tokenizer", "n_tokens"],
            )

    return count


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The counts stored for one tokenizer version; the cache is made if it is missing."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException:
        spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(cache)
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return rows.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, model_path: str) -> None:
    """Encode the distinct texts that the cache lacks and append their counts to it.

    Equal texts are merged in each input task before the shuffle, so a text that fills a
    third of the table reaches no task more than once per input task. An append of a failed
    or repeated run adds equal rows, which reading merges.
    """
    spark, version = docs.sparkSession, tokenizer_version(model_path)
    text = normalised(F.col("text"))
    distinct = docs.select(F.sha2(text, 256).alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    misses = distinct.join(cached_counts(spark, cache, version), "digest", "left_anti")
    misses.mapInArrow(_counter(model_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, cache: str, model_path: str, limit: int) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Texts are counted whole; NULL and empty texts have 0 bytes. Every row is kept, repeated
    ones too. Columns of the input with these names are replaced.
    """
    fill_cache(docs, cache, model_path)
    text = normalised(F.col("text"))
    # Written out, the counts meet the rows in a plain join, of which Spark can split a
    # digest that a third of the rows share.
    counts = stored(cached_counts(docs.sparkSession, cache, tokenizer_version(model_path)), "counts")
    rows = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "_digest": F.sha2(text, 256)})
    rows = rows.drop("text", "n_tokens", "over_limit")
    found = rows.join(counts.withColumnRenamed("digest", "_digest"), "_digest").drop("_digest")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
