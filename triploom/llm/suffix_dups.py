"""Repeated passages by a sparse suffix array over the words of all documents.

Only the suffixes at content-selected positions are kept: of every ``length - block + 1``
successive blocks of ``block`` words the one with the smallest hash. So any ``length`` words
hold a kept position, and the same one in each of their copies. The suffixes are sorted by
the hash of their leading block; a suffix whose neighbour starts with the same block is a
match, which is extended left and right, word by word, to all windows of ``length`` words
around it that occur in another document too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.storage import only, small, stored

LENGTH = 50
BLOCK = 26
CACHE_WORDS = 300_000
TEXT = ["doc_id", "nth"]
SUFFIX = [*TEXT, "at", "lead"]
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``factor ** i`` and its inverse for ``i <= n``, modulo 2 ** 64."""
    inverse = pow(factor, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, factor, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)], dtype=np.uint64)
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of words, and of all runs of ``n`` words, of a text."""

    def __init__(self) -> None:
        self._words: dict[bytes, int] = {}
        self._tables = {f: _powers(f, 1 << 12) for f in FACTORS}

    def words(self, text: bytes) -> np.ndarray:
        tokens, known = text.split(), self._words
        new = [w for w in tokens if w not in known]
        if new:
            if len(known) > CACHE_WORDS:
                known.clear()
                new = tokens
            known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def runs(self, words: np.ndarray, n: int, factor: int = FACTORS[0]) -> np.ndarray:
        if len(words) < n:
            return np.empty(0, np.uint64)
        while len(self._tables[factor][0]) <= len(words):
            self._tables[factor] = _powers(factor, 2 * len(self._tables[factor][0]))
        up, down = self._tables[factor]
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum(words * up[: len(words)], dtype=np.uint64)]
            return _mixed((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def _sliding(values: np.ndarray, window: int, choose: np.ufunc) -> np.ndarray:
    """``choose`` (minimum or maximum) over each ``window`` successive values."""
    reach, out = 1, values
    while 2 * reach <= window:
        out, reach = choose(out[:-reach], out[reach:]), 2 * reach
    return choose(out[: len(values) - window + 1], out[window - reach :])


def minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """The positions of the smallest hash, of all equal ones, of each ``window`` hashes.

    A text with fewer hashes than that has none.
    """
    if len(hashes) < window:
        return np.empty(0, np.int64)
    least = _sliding(hashes, window, np.minimum)
    none = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.r_[none, least, none], window, np.maximum) == hashes)


def _suffixes(length: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for doc, nth, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "nth", "_bytes")), strict=True):
                    hashes = hasher.runs(hasher.words(text), block)
                    at = minimisers(hashes, length - block + 1)
                    rows.append((np.full(len(at), doc, np.int64), np.full(len(at), nth, np.int64), at.astype(np.int32), hashes[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=["doc_id", "nth", "at", "lead"])

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition the suffixes with an equal neighbour, and its two end rows."""

    def out(rows, end) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(rows, kinds, strict=True)), pa.array(end, pa.bool_())], names=[*SUFFIX, "end"])

    held = None  # the last row of the batch before, and whether it is a match
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in SUFFIX]
        if held is None:
            yield out([c[:1] for c in rows], [True])
        else:
            rows = [np.r_[h, c] for h, c in zip(held[0], rows, strict=True)]
        same = rows[-1][1:] == rows[-1][:-1]
        match = np.r_[same, False] | np.r_[held[1] if held else False, same]
        yield out([c[:-1][match[:-1]] for c in rows], np.zeros(match[:-1].sum(), bool))
        held = [c[-1:] for c in rows], bool(match[-1])
    if held is not None:
        yield out(held[0], [True])
        if held[1]:
            yield out(held[0], [False])


def matched_suffixes(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``nth`` (the text) and ``at`` of the kept suffixes whose leading block occurs once more.

    Ties are sorted by document and position, so a block that a third of all suffixes start
    with spreads over many partitions; the end rows of partitions are compared apart.
    """
    suffixes = stored(docs.mapInArrow(_suffixes(length, block), "doc_id long, nth long, at int, lead long"), "suffixes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["lead", *TEXT, "at"]
    compared = suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours, "doc_id long, nth long, at int, lead long, end boolean")
    compared = stored(compared, "neighbours")
    ends = compared.filter("end").select(*order).distinct()
    shared = ends.groupBy("lead").agg(F.count("*").alias("_n")).filter("_n > 1").select("lead")
    matches = compared.filter("not end").select(*TEXT, "at").unionByName(ends.join(shared, "lead", "left_semi").select(*TEXT, "at"))
    return matches.distinct()


def _windows(length: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, reach = Hasher(), length - block
        for batch in batches:
            for i in range(batch.num_rows):
                words = hasher.words(batch.column("_bytes")[i].as_py())
                count = len(words) - length + 1
                if count < 1:
                    continue
                at = np.array(batch.column("at")[i].as_py(), np.int64)
                edge = np.zeros(len(words) + 2, np.int64)
                np.add.at(edge, np.clip(at - reach, 0, count), 1)
                np.add.at(edge, np.clip(at + 1, 0, count), -1)
                start = np.flatnonzero(np.cumsum(edge)[:count] > 0)
                one, two = (hasher.runs(words, length, f)[start].view(np.int64) for f in FACTORS)
                text = [pa.array(np.full(len(start), batch.column(c)[i].as_py(), np.int64)) for c in TEXT]
                yield pa.RecordBatch.from_arrays([*text, pa.array(start.astype(np.int32)), pa.array(one), pa.array(two)], names=[*TEXT, "start", "one", "two"])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("_bytes").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array([len(t.split()) for t in texts], pa.int32())],
            names=["doc_id", "digest", "n_words"],
        )


def repeated_passages(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """The passages of ``length`` words or more that also occur in another document.

    Words are what stands between ASCII white space. The result has a row per passage:
    ``doc_id``, ``start_word`` (from 0) and ``n_words``. A passage is a run of windows of
    ``length`` words, each of which occurs elsewhere, that overlap or touch. Shorter, empty and NULL texts
    have none. Rows without a doc_id are left out. Rows that share one count as one document
    where copies are looked for, but each of their different texts has its own passages;
    repeated rows say nothing new. No limit is set on the number of copies.

    Equal texts are one passage each, from end to end; only the first of them enters the
    suffix array, in which the others would repeat all that it says.
    """
    docs = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_bytes"))
    digests = stored(docs.mapInArrow(_digests, "doc_id long, digest binary, n_words int").filter(F.col("n_words") >= length), "digests")
    # Texts of one document are told apart by 64 bits of their digests; other documents have
    # the text 0, so that the tables of all suffixes hold no digests.
    several = stored(digests.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a != b").select("doc_id", F.lit(True).alias("_several")), "several-texts")
    several = F.broadcast(several) if small(several, 64) else several

    def told_apart(rows: DataFrame, digest: Column) -> DataFrame:
        nth = F.conv(F.substring(F.hex(digest), 1, 16), 16, -10).cast("long")
        return rows.join(several, "doc_id", "left").withColumn("nth", F.when(F.col("_several"), nth).otherwise(F.lit(0).cast("long"))).drop("_several")

    alike = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    copies = stored(told_apart(digests.join(alike, "digest").distinct(), F.col("digest")), "copies")
    docs = told_apart(docs, F.unhex(F.sha2("_bytes", 256)))
    docs = only(docs, stored(copies.filter("doc_id > first").select(*TEXT).distinct(), "later-copies"), "left_anti", TEXT)
    matches = stored(matched_suffixes(docs, length, block).groupBy(*TEXT).agg(F.collect_list("at").alias("at")), "matches")
    rows = only(docs, matches.select(*TEXT), "left_semi", TEXT).join(matches, TEXT)
    windows = rows.mapInArrow(_windows(length, block), "doc_id long, nth long, start int, one long, two long")
    holders = windows.groupBy("one", "two").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).filter("_low < _high")
    # Written out, so that Spark can split the join at a window that many documents share.
    holders = stored(holders.select("one", "two"), "holders")
    found = stored(windows.join(holders, ["one", "two"]).select(*TEXT, "start"), "found").distinct()
    order = Window.partitionBy(*TEXT).orderBy("start")
    fresh = F.coalesce((F.col("start") > F.lag("start").over(order) + length).cast("int"), F.lit(1))
    passages = found.withColumn("_new", fresh).withColumn("_passage", F.sum("_new").over(order))
    passages = passages.groupBy(*TEXT, "_passage").agg(F.min("start").alias("start_word"), (F.max("start") - F.min("start") + length).alias("n_words")).drop("_passage")
    single = passages.join(copies.select(*TEXT).distinct(), TEXT, "left_anti").drop("nth")
    return single.unionByName(copies.select("doc_id", F.lit(0).alias("start_word"), "n_words"))
