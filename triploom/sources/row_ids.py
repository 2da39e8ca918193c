"""Row numbers in the order of the files, whatever the splits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.sources.checkpoints import cut_lineage

BROADCAST_BLOCKS = 100_000


def with_file_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... in the order of the files' paths and their rows.

    The number of a row depends on the files alone, not on how they were split or dealt to
    tasks. Parquet tells each row's place in its file, so there ``df`` may have been filtered
    or shuffled before; numbers then follow the unfiltered file up to the last row that is
    left in it. For other formats the rows are counted per block of a file as it is read, so
    ``df`` must come from the scan without a shuffle. What is read twice are the file's
    places, not its columns. A table that wasn't read from files gets Spark's own numbers.
    """
    place = {"_file": "_metadata.file_path", "_start": "_metadata.file_block_start"}
    try:
        located = df.withColumns({c: F.col(source) for c, source in place.items()})
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    try:
        located = located.drop("_start").withColumn("_at", F.col("_metadata.row_index"))
        block, rows, first = ["_file"], F.max("_at") + 1, F.lit(0).cast("long")
    except AnalysisException:
        located = located.withColumn("_at", F.monotonically_increasing_id())
        block, rows, first = ["_file", "_start"], F.count(F.lit(1)), F.min("_at")
    blocks = located.groupBy(*block).agg(rows.alias("_rows"), first.alias("_first"))
    earlier = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    blocks = cut_lineage(blocks.select(*block, (before - F.col("_first")).alias("_offset")))
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    return located.join(blocks, block).select(
        *df.columns, (F.col("_at") + F.col("_offset")).alias(name)
    )
