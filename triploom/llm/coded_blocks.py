"""Corpora as blocks of codes, each with a dictionary of its own.

A block holds the distinct keys of some texts once and, in place of the texts, the numbers
of their keys. What is to be known of a key is found once and told to every block that has
it, however often it occurs there; the block then puts the answers in place of the codes.
So a key that is in every text costs one entry per block, and nothing is shuffled per
occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fill = Callable[[pa.Table, pa.Table], Iterable[pa.RecordBatch]]


class Numbering:
    """Numbers that no other task of the stage gives out."""

    def __init__(self) -> None:
        self._next = TaskContext.get().partitionId() << 32

    def __call__(self) -> int:
        self._next += 1
        return self._next


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative integers below 2^32, compressed; high and low bytes apart, as the high ones repeat."""
    raw = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    width = 4 if numbers.max(initial=0) >> 16 else 2
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(raw[:, :width].T).tobytes(), 3)


def unpacked(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(content[1:]), np.uint8).reshape(content[0], -1)
    out = np.zeros(planes.shape[1], np.uint32)
    for place, plane in enumerate(planes):
        out |= plane.astype(np.uint32) << np.uint32(8 * place)
    return out


def put_back(blocks: DataFrame, answers: DataFrame, new_fill: Callable[[], Fill], schema: str) -> DataFrame:
    """What ``fill(block, answers)`` gives for every row of ``blocks``, ``fill`` being made anew in each task.

    ``block`` and ``part`` number the blocks; parts of one block meet in one task, in their
    order. ``answers`` has these columns, ``code`` and more; ``fill`` gets those of its block
    in the order of ``code``. A task streams sorted rows and holds the answers of one block
    part at a time.
    """
    key = ["block", "part"]
    own, told = F.struct(*[c for c in blocks.columns if c not in key]), F.struct(*[c for c in answers.columns if c not in key])
    block_type, answer_type = blocks.select(own).schema[0].dataType, answers.select(told).schema[0].dataType
    rows = blocks.select(*key, F.lit(1).alias("kind"), own.alias("own"), F.lit(None).cast(answer_type).alias("told"))
    more = answers.select(*key, F.lit(0).alias("kind"), F.lit(None).cast(block_type).alias("own"), told.alias("told"))
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.unionByName(more).repartition(parts, "block").sortWithinPartitions(*key, "kind", "told.code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill, held = new_fill(), []
        for batch in batches:
            at = 0
            for kind, same in groupby(batch.column("kind").to_pylist()):
                n = len(list(same))
                if kind == 0:
                    held.append(batch.column("told").slice(at, n))
                else:
                    none = batch.column("told").slice(0, 0)
                    for i in range(at, at + n):
                        yield from fill(_table([batch.column("own").slice(i, 1)]), _table(held or [none]))
                        held = []
                at += n

    return placed.mapInArrow(run, schema)


def _table(rows: list[pa.StructArray]) -> pa.Table:
    return pa.Table.from_batches([pa.RecordBatch.from_struct_array(r) for r in rows]).combine_chunks()
