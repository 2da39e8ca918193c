"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.llm.ranks import gapless
from triploom.llm.storage import stored

EXACT_BITS = 10


class _Node:
    __slots__ = ("key", "left", "priority", "right")

    def __init__(self, key, priority):
        self.key, self.priority, self.left, self.right = key, priority, None, None


class BinTree:
    """Balanced search tree (a treap) of ``(room left, bin)``."""

    def __init__(self) -> None:
        self._root, self._random = None, random.Random(7)

    def _split(self, node, key):
        """The subtree below ``key`` and the rest."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        rest, node.left = self._split(node.left, key)
        return rest, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low.priority > high.priority:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high

    def add(self, room: int, number: int) -> None:
        low, high = self._split(self._root, (room, number))
        self._root = self._merge(self._merge(low, _Node((room, number), self._random.random())), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that ``size`` still fits into."""
        node, best = self._root, None
        while node is not None:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        if best is not None:
            low, rest = self._split(self._root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self._root = self._merge(low, high)
        return best


def best_fit(sizes: list[int], counts: list[int], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Pack ``counts[i]`` groups of ``sizes[i]``, sizes falling: runs ``(i, bin, groups)``.

    Equal sizes are placed as one: the tightest bin that takes one of them takes as many as
    fit, which is what placing them singly gives. Groups above the capacity get own bins.
    None if that takes more than ``most`` bins.
    """
    tree, runs, bins = BinTree(), [], 0
    for i, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        while count:
            found = tree.take_tightest(size)
            if found is None:
                if bins == most:
                    return None
                found, bins = (max(capacity, size), bins), bins + 1
            room, number = found
            fit = min(count, room // size) if size else count
            runs.append((i, number, fit))
            tree.add(room - fit * size, number)
            count -= fit
    return runs


def smallest_capacity(sizes: list[int], counts: list[int], bins: int) -> int:
    """The least capacity, to a thousandth, at which best fit needs at most ``bins`` bins.

    It may lie below the largest groups: these then fill bins of their own, and the rest is
    spread evenly over the others.
    """
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    low, high = 0, -(-total // bins) + max(sizes, default=0)
    while best_fit(sizes, counts, high, bins) is None:
        low, high = high, 2 * high
    while high - low > max(1, high // 1000):
        middle = (low + high) // 2
        low, high = (middle, high) if best_fit(sizes, counts, middle, bins) is None else (low, middle)
    return high


def size_class(size: Column) -> Column:
    """The size with all but its ten leading bits cleared: a few thousand values in all."""
    cut = F.greatest(F.lit(0), F.length(F.bin(size)) - EXACT_BITS).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, cut), cut)


def packed_groups(groups: DataFrame, size: str, order: list[str], bins: int | None = None, capacity: int | None = None) -> DataFrame:
    """Add the column ``shard`` to ``groups``, one row per indivisible group.

    Groups of one size class are alike for the packing, so it needs only the number and
    one size of each class: the mean to fill ``bins`` evenly, the largest where no shard may
    exceed a ``capacity`` (but for a group that does so alone). That table has at most ``2 ** EXACT_BITS`` classes per
    power of two, whatever the number of groups, and is packed on the driver; the groups
    learn their shard from their rank in the class, in parallel. Give ``capacity`` to use
    as few shards of that size as best fit finds, or ``bins`` for the least capacity at
    which that many shards do. Empty input gives no shards.
    """
    ranked = gapless(groups.withColumn("_class", -size_class(F.col(size))), "_class", order, "_rank")
    ranked = stored(ranked, "packing")
    total = F.sum(size) if capacity is None else F.max(size) * F.count("*")
    classes = ranked.groupBy("_class").agg(F.count("*").alias("n"), total.alias("s")).orderBy("_class").collect()
    counts = [r["n"] for r in classes]
    sizes = [-(-r["s"] // r["n"]) for r in classes]
    if capacity is None:
        capacity = smallest_capacity(sizes, counts, bins)
    runs = best_fit(sizes, counts, capacity)
    first = dict(zip([r["_class"] for r in classes], np.cumsum([0, *counts])[:-1].tolist(), strict=True))
    ends = np.cumsum([fit for _, _, fit in runs])
    numbers = np.array([number for _, number, _ in runs], dtype=np.int32)

    @F.pandas_udf(T.IntegerType())
    def shard_of(kind: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(numbers[np.searchsorted(ends, kind.map(first) + rank, side="right")])

    return ranked.withColumn("shard", shard_of("_class", "_rank")).drop("_class", "_rank")


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and the gapless ``slot``.

    Documents with equal texts are one group and stay together; so the sizes of the shards
    are near equal unless one group is larger than a shard. A NULL text has size 8, crc32 0
    and is its own kind of text, apart from the empty one. Repeated rows are kept, each with
    a slot of its own. A column of the input that is named like one of these is replaced.
    """
    text = F.col("text")
    base = docs.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8,
            "text_crc32": F.coalesce(F.crc32(text.cast("binary")), F.lit(0)),
            "_text": F.coalesce(F.sha2(text, 256), F.lit("")),
        }
    ).drop("text", "shard", "slot")
    base = stored(base, "sharding")
    groups = base.groupBy("_text").agg(F.sum("size").alias("_bytes"))
    packed = packed_groups(groups, "_bytes", ["_text"], bins=shards).select("_text", "shard")
    placed = base.join(packed, "_text")
    return gapless(placed, "shard", ["_text", "doc_id"], "slot").drop("_text")
