"""Salting of join keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.sources.checkpoints import cut_lineage

HOT_ROWS = 50_000
BROADCAST_KEYS = 100_000

Spread = Callable[[DataFrame], DataFrame]


def split_hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    row_id: str | Sequence[str],
    salt: str = "salt",
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, Spread, list[str]]:
    """Prepare ``rows`` for a join on ``keys`` that any key may dominate.

    Returns the rows, a function that prepares the other side of the join, and the keys
    to join on. Without hot keys all three are as given. Otherwise the rows of a hot key
    get one of its salts 1, 2, ... by hashed ``row_id``, all others get salt 0, and the
    other side is copied once per salt of its key. Counting combines inside the input
    partitions first, so it is not itself subject to the skew.
    """
    keys = list(keys)
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > hot_rows)
        .select(*keys, F.ceil(F.col("rows") / hot_rows).cast("int").alias("parts"))
    )
    found = hot.limit(BROADCAST_KEYS + 1).count()
    if found == 0:
        return rows, lambda other: other, keys
    # Beyond that the hot keys are written out: Spark splits the skew of a join with a
    # stored table by itself.
    hot = F.broadcast(hot) if found <= BROADCAST_KEYS else cut_lineage(hot)
    parts = F.col("parts")
    unsplit = F.array(F.lit(0))

    def spread(other: DataFrame) -> DataFrame:
        salts = F.when(parts.isNull(), unsplit).otherwise(F.sequence(F.lit(1), parts))
        return other.join(hot, keys, "left").withColumn(salt, F.explode(salts)).drop("parts")

    own_salt = F.when(parts.isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*row_id), parts).cast("int") + 1
    )
    salted = rows.join(hot, keys, "left").withColumn(salt, own_salt)
    return salted.drop("parts"), spread, [*keys, salt]
