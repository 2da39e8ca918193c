"""Near-duplicates by SimHash, linked with the generalised pigeonhole principle.

The bits of the fingerprints are grouped into parts of correlated bits. With thresholds
``t_i >= -1`` whose ``t_i + 1`` add up to ``radius + 1``, two fingerprints within the radius
differ in at most ``t_i`` bits of some part ``i`` (-1 skips the part). Dynamic programming
picks the thresholds of every fingerprint anew, from the counts of part values: parts in
which its value is frequent are skipped, others are probed with flipped bits.

Within a large set of near copies all parts are frequent. Where even the best thresholds
cost more than it does, a fingerprint takes the division into one part of all bits, probed
by flips from both ends: two fingerprints within two bits share a value that is one flip
from both. A pair is found if either end is probed the first way, or by the second if both
are, so no link is lost, and no value gathers more rows than the limit or the 65 flips.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.llm.components import components
from triploom.llm.storage import only, stored

BITS = 64
PARTS = 3
BUCKETS = 1 << 16
AT_ONCE = 4096
ONE = np.uint64(1)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words of the lower-cased text."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) <= words:
        runs = [b" ".join(tokens)]
    else:
        runs = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(r, 42) for r in runs], dtype=np.uint64)


def fingerprints(texts: list[bytes | None], words: int) -> np.ndarray:
    """A fingerprint per text: the bits set in over half of its shingle hashes; none gives 0."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text or b"", words)
        if len(hashes):
            votes = np.zeros(BITS, np.int64)
            for start in range(0, len(hashes), AT_ONCE):
                part = hashes[start : start + AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
                votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * votes > len(hashes)).view(">u8")[0]
    return out


def _fingerprinter(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = fingerprints(part.column("_bytes").to_pylist(), words).view(np.int64)
                kept = [c for c in part.schema.names if c != "_bytes"]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(found)], names=[*kept, "fp"])

    return run


def with_fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (a signed 64-bit integer) of every row; a NULL text has no words."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_bytes"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(_fingerprinter(words), schema)


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    together = np.zeros((BITS, BITS))
    for batch in batches:
        bits = np.unpackbits(_fps(batch).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(np.float32)
        together += bits.T @ bits
    yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(BITS * BITS)), "n": pa.array(together.ravel())})


def correlated_parts(fps: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """Group the 64 bits into ``parts`` of near equal size, correlated bits together.

    The correlations come from all fingerprints, summed in the tasks; the driver sees one
    64 x 64 matrix. Each part starts from the bit most correlated with those still free.
    """
    cells = fps.select("fp").mapInArrow(_gram, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    together = np.zeros(BITS * BITS)
    for row in cells:
        together[row["cell"]] = row["n"]
    together = together.reshape(BITS, BITS)
    rows = max(1, fps.count())
    mean = np.diag(together) / rows
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    strength = np.abs((together / rows - np.outer(mean, mean)) / np.outer(spread, spread))
    free, groups = list(range(BITS)), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        group = [max(free, key=lambda b: strength[b, free].sum())]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: strength[b, group].mean()))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def part_value(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint, packed."""
    out = np.zeros(len(fps), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & ONE) << np.uint64(place)
    return out


def _bucket(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64) % BUCKETS


def _histogram(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(groups), BUCKETS), np.int64)
        for batch in batches:
            for i, bits in enumerate(groups):
                counts[i] += np.bincount(_bucket(part_value(_fps(batch), bits)), minlength=BUCKETS)
        cells = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "n": pa.array(counts.ravel()[cells])})

    return run


def value_counts(fps: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """At least the number of fingerprints with a part's value, in ``BUCKETS`` per part.

    The table has the same size for any input. With more fingerprints than it can tell
    apart, more of them take the probing by flips, whose cost is fixed.
    """
    cells = fps.select("fp").mapInArrow(_histogram(groups), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(len(groups) * BUCKETS, np.int64)
    found = cells.toArrow()
    table[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(len(groups), BUCKETS)


def flips(bits: int, most: int) -> np.ndarray:
    """Masks with at most ``most`` of ``bits`` bits set, fewest first."""
    masks = [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(range(bits), n)]
    return np.array(masks, dtype=np.uint64)


def allocate(costs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest thresholds per fingerprint, and their cost, by dynamic programming.

    ``costs[i, u]`` are the costs, one per fingerprint, of threshold ``u - 1`` in part ``i``.
    The ``u`` of all parts add up to ``radius + 1``.
    """
    parts, _, rows = costs.shape
    best = np.full((radius + 2, rows), np.inf)
    best[0] = 0
    choice = np.zeros((parts, radius + 2, rows), np.int8)
    for i in range(parts):
        after = np.full_like(best, np.inf)
        for spent in range(radius + 2):
            for u in range(spent + 1):
                cost = best[spent - u] + costs[i, u]
                better = cost < after[spent]
                after[spent] = np.where(better, cost, after[spent])
                choice[i, spent] = np.where(better, u, choice[i, spent])
        best = after
    picked = np.zeros((parts, rows), np.int8)
    left = np.full(rows, radius + 1)
    for i in reversed(range(parts)):
        picked[i] = choice[i, left, np.arange(rows)]
        left = left - picked[i]
    return picked - 1, best[radius + 1]


def _prober(groups: list[list[int]], counts: np.ndarray, radius: int, limit: int):
    """Rows ``(kind, part, value, fp)``: index entries (0), probes (1) and flips of all bits (2)."""
    masks = [[flips(len(bits), t) for t in range(radius + 1)] for bits in groups]
    whole = flips(BITS, radius // 2 + radius % 2)

    def out(kind: int, part: int, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, part, np.int8)), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64))],
            names=["kind", "part", "value", "fp"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                fps = _fps(batch.slice(start, AT_ONCE)).copy()
                values = [part_value(fps, bits) for bits in groups]
                costs = np.zeros((len(groups), radius + 2, len(fps)))
                for i, value in enumerate(values):
                    for t in range(radius + 1):
                        probes = masks[i][t]
                        costs[i, t + 1] = len(probes) + sum(counts[i, _bucket(value ^ m)] for m in probes)
                thresholds, cost = allocate(costs, radius)
                dense = cost > limit
                for i, value in enumerate(values):
                    rare = counts[i, _bucket(value)] <= limit  # others are in no probe's reach
                    yield out(0, i, value[rare], fps[rare])
                    for t in range(radius + 1):
                        chosen = ~dense & (thresholds[i] == t)
                        if chosen.any():
                            probes = (value[chosen][:, None] ^ masks[i][t][None, :]).ravel()
                            yield out(1, i, probes, np.repeat(fps[chosen], len(masks[i][t])))
                if dense.any():
                    yield out(2, -1, (fps[dense][:, None] ^ whole[None, :]).ravel(), np.repeat(fps[dense], len(whole)))

    return run


def linked(fps: DataFrame, radius: int = 2, limit: int = BITS + 1) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct ``fp`` that connect all within ``radius`` differing bits.

    Every pair is itself within the radius. In dense sets, pairs are left out whose ends
    stay connected through the smallest fingerprint next to a shared flip.
    """
    if radius % 2:
        raise ValueError("flips from both ends need an even radius")
    groups = correlated_parts(fps)
    counts = value_counts(fps, groups)
    rows = stored(fps.select("fp").mapInArrow(_prober(groups, counts, radius, limit), "kind byte, part byte, value long, fp long"), "probes")
    index = rows.filter("kind = 0").select("part", "value", F.col("fp").alias("a"))
    probes = rows.filter("kind = 1").select("part", "value", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, radius)
    sparse = index.join(probes, ["part", "value"]).filter(near).select("a", "b")
    meetings = rows.filter("kind = 2").groupBy("value").agg(F.collect_set("fp").alias("all")).filter("size(all) > 1")
    dense = meetings.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a != b")
    return sparse.unionByName(dense)


def near_duplicates(docs: DataFrame, radius: int = 2, words: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row of ``docs``.

    Equal fingerprints are one node, so copies cost one row each. NULL, empty and blank
    texts have fingerprint zero and link like any other. The component is the smallest
    doc_id reachable; rows without a doc_id count as larger than all, and a component of
    only such rows has none. Repeated rows are kept. Other columns are not carried along.
    """
    base = stored(with_fingerprints(docs, words), "fingerprints")
    nodes = stored(base.groupBy("fp").agg(F.min("doc_id").alias("_least")), "distinct-fingerprints")
    roots = components(linked(nodes, radius), "a", "b").withColumnRenamed("node", "fp")
    joined = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = joined.join(least, "root").select("fp", "component_id")
    return base.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _row_key() -> Column:
    """Tells rows apart by doc_id and text, known and small doc_ids first."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), digest.alias("digest"))


def one_of_each(docs: DataFrame, radius: int = 2, words: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest doc_id.

    Rows are told apart by doc_id and text, so of rows that share a doc_id only near copies
    of another row go. Rows without a doc_id come after all others. Of rows with equal doc_id
    and text the smallest by all columns stays. The decision is joined by key: ``docs`` is
    shuffled only where the keys to drop don't fit a broadcast.
    """
    keyed = docs.select(_row_key().alias("doc_id"), "text")
    groups = near_duplicates(keyed, radius, words)
    rows = groups.groupBy(F.col("doc_id").alias("key")).agg(F.first(F.col("doc_id") == F.col("component_id")).alias("first"), F.count("*").alias("n"))
    rows = rows.filter("not first or n > 1").select(F.md5(F.to_json("key").cast("binary")).alias("_key"), "first")
    rows = stored(rows, "not-single")
    marked = docs.withColumn("_key", F.md5(F.to_json(_row_key()).cast("binary")))
    single = only(marked, rows.select("_key"), "left_anti", "_key").drop("_key")
    repeated = only(marked, rows.filter("first").select("_key"), "left_semi", "_key")
    smallest = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("row")
    return single.unionByName(repeated.groupBy("_key").agg(smallest).select("row.*"))
