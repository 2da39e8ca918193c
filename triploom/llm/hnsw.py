"""Approximate nearest neighbours: one navigable small-world graph per shard.

A graph is kept as flat arrays: the neighbours of all points on a level in one matrix of
integers, -1 where a point has fewer. Graphs are files in the shared folder; searches are
dealt out as (shard, block of queries), and the nearest of all shards are merged.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.storage import open_folder, shared_folder, stored

LINKS = 16
BUILD_WIDTH = 96
SEARCH_WIDTH = 128
SHARD_ROWS = 32_768
LEAST_SHARDS = 12
BLOCK_QUERIES = 1_024


class Graph:
    """A hierarchical navigable small-world graph over the rows of ``points`` (L2 distance)."""

    def __init__(self, points: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH) -> None:
        self.points, self.links, self.width = np.ascontiguousarray(points, np.float64), links, width
        n = len(points)
        draws = np.random.default_rng(n).random(n)
        self.levels = np.minimum((-np.log(1 - draws) / math.log(links)).astype(np.int32), 12) if n else np.empty(0, np.int32)
        self.neighbours = [np.full((n, 2 * links if level == 0 else links), -1, np.int32) for level in range(int(self.levels.max(initial=0)) + 1)]
        self._norms = (self.points**2).sum(axis=1)
        self._seen, self._mark = np.zeros(n, np.int64), 0
        self.entry = -1
        for point in range(n):
            self._insert(point)

    def _distances(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._norms[at] - 2 * (self.points[at] @ query)

    def _search(self, query: np.ndarray, entries: list[tuple[float, int]], level: int, width: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found from ``entries``, nearest first."""
        self._mark += 1
        seen, mark, table = self._seen, self._mark, self.neighbours[level]
        seen[[p for _, p in entries]] = mark
        queue = list(entries)
        heapq.heapify(queue)
        best = [(-d, p) for d, p in entries]
        heapq.heapify(best)
        while queue:
            near, point = heapq.heappop(queue)
            if len(best) >= width and near > -best[0][0]:
                break
            around = table[point]
            around = around[around >= 0]
            around = around[seen[around] != mark]
            if not len(around):
                continue
            seen[around] = mark
            far = self._distances(query, around)
            if len(best) >= width:
                closer = far < -best[0][0]
                around, far = around[closer], far[closer]
            for d, p in zip(far.tolist(), around.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (-d, p))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, p))
                else:
                    continue
                heapq.heappush(queue, (d, p))
        return sorted((-d, p) for d, p in best)

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of the nearest, those nearer to the point than to each other; then the nearest rest."""
        at = np.array([p for _, p in found])
        near = np.array([d for d, _ in found])
        own = self.points[at]
        between = self._norms[at][:, None] + self._norms[at][None, :] - 2 * (own @ own.T)
        kept, blocked = [], np.zeros(len(at), bool)
        for i in range(len(at)):
            if not blocked[i]:
                kept.append(i)
                if len(kept) == most:
                    break
                blocked |= between[i] < near
        rest = [i for i in range(len(at)) if i not in set(kept)]
        return at[(kept + rest)[:most]].tolist()

    def _insert(self, point: int) -> None:
        top = int(self.levels[point])
        if self.entry < 0:
            self.entry = point
            return
        query = self.points[point]
        entries = [(float(self._distances(query, np.array([self.entry]))[0]), self.entry)]
        highest = int(self.levels[self.entry])
        for level in range(highest, top, -1):
            entries = self._search(query, entries, level, 1)
        for level in range(min(top, highest), -1, -1):
            entries = self._search(query, entries, level, self.width)
            table = self.neighbours[level]
            lifted = [(d + float(self._norms[point]), p) for d, p in entries]
            chosen = self._spread(lifted, self.links)
            table[point, : len(chosen)] = chosen
            for other in chosen:
                row = table[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = point
                else:
                    at = np.append(row, point)
                    d = self._distances(self.points[other], at) + self._norms[other]
                    order = np.argsort(d)
                    row[:] = self._spread(list(zip(d[order].tolist(), at[order].tolist(), strict=True)), len(row))
        if top > highest:
            self.entry = point

    def nearest(self, query: np.ndarray, count: int, width: int = SEARCH_WIDTH) -> list[int]:
        """Row numbers of the ``count`` nearest points found, nearest first."""
        if self.entry < 0:
            return []
        entries = [(float(self._distances(query, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            entries = self._search(query, entries, level, 1)
        return [p for _, p in self._search(query, entries, 0, max(width, count))[:count]]

    def dump(self, **extra: np.ndarray) -> bytes:
        out = io.BytesIO()
        tables = {f"level{i}": t for i, t in enumerate(self.neighbours)}
        np.savez(out, points=self.points, levels=self.levels, entry=self.entry, **tables, **extra)
        return out.getvalue()

    @classmethod
    def load(cls, content: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        data = dict(np.load(io.BytesIO(content)))
        graph = cls.__new__(cls)
        graph.points, graph.levels, graph.entry = data.pop("points"), data.pop("levels"), int(data.pop("entry"))
        graph.neighbours = [data.pop(f"level{i}") for i in range(sum(k.startswith("level") for k in data))]
        graph._norms = (graph.points**2).sum(axis=1)
        graph._seen, graph._mark = np.zeros(len(graph.points), np.int64), 0
        return graph, data


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector is not NULL, empty or zero and has finite components only."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))


def _builder(folder: str, longest: float):
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim, shard = key
        rows = rows.sort_values("rep")
        points = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        # one more component makes the smallest distance the largest inner product; it may be
        # far larger than the others, which single precision would then lose
        rest = np.sqrt(np.maximum(longest**2 - (points**2).sum(axis=1), 0))
        graph = Graph(np.c_[points, rest])
        files, path = open_folder(folder)
        name = f"{dim}-{shard}.npz"
        with files.open_output_stream(f"{path}/{name}") as out:
            out.write(graph.dump(reps=rows["rep"].to_numpy(), original=points))
        return pd.DataFrame({"dim": [dim], "shard": [shard], "path": [f"{folder}/{name}"]})

    return build


@lru_cache(maxsize=1)
def _loaded(uri: str):
    files, path = open_folder(uri.rpartition("/")[0])
    with files.open_input_stream(f"{path}/{uri.rpartition('/')[2]}") as stream:
        return Graph.load(stream.read())


def _searcher(count: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        graph, data = _loaded(rows["path"].iloc[0])
        found = []
        for query, vector in zip(rows["query"].to_numpy(), rows["vector"], strict=True):
            exact = np.asarray(vector, np.float64)
            at = graph.nearest(np.append(exact, 0), count)
            scores = data["original"][at] @ exact
            found.append(pd.DataFrame({"query": query, "rep": data["reps"][at], "score": scores}))
        return pd.concat(found)

    return search


def nearest(vectors: DataFrame, id_col: str, column: str, queries: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` largest inner products found.

    Queries are the rows that meet the SQL condition ``queries``; candidates are all rows
    but the query's own. Equal vectors are one point of the graph, so copies can't crowd
    each other out: of each only the ``k + 1`` smallest ids can be among the ``k`` nearest.
    Ties go to the smaller id. Rows without an id, and vectors that are NULL, empty, zero or
    not finite, take no part; vectors of different length are never compared. Of rows that
    repeat an id and vector one takes part.
    """
    rows = usable(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector")), "vector")
    rows = rows.filter("id is not null").withColumn("dim", F.size("vector"))
    rows = stored(rows, "vectors")
    # Spark limits the rows of each value before the shuffle, so a frequent vector stays small.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    members = stored(rows.distinct().withColumn("place", place).filter(F.col("place") <= k + 1), "members")
    reps = members.filter("place = 1").withColumnRenamed("id", "rep")
    named = stored(members.select("vector", "id").join(reps.select("vector", "rep"), "vector").select("rep", "id"), "copies")
    wanted = rows.filter(queries).select("id", "vector").distinct()
    asked = stored(wanted.join(reps.select("vector", "rep"), "vector").select(F.col("id").alias("query_id"), F.col("rep").alias("query")), "queries")
    stats = reps.agg(F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    shards = max(LEAST_SHARDS, -(-stats["n"] // shard_rows))
    folder = shared_folder(vectors.sparkSession, "graphs")
    dealt = reps.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    graphs = stored(dealt.groupBy("dim", "shard").applyInPandas(_builder(folder, math.sqrt(stats["m"] or 0.0)), "dim int, shard int, path string"), "graphs")
    points = reps.join(asked.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi")
    block = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(-(-stats["n"] // BLOCK_QUERIES) or 1))
    tasks = points.select("dim", F.col("rep").alias("query"), "vector", block.alias("block")).join(F.broadcast(graphs), "dim")
    hits = tasks.groupBy("path", "block").applyInPandas(_searcher(k + 1), "query long, rep long, score double")
    merged = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    hits = hits.withColumn("_n", F.row_number().over(merged)).filter(F.col("_n") <= k + 1).drop("_n")
    ordered = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = stored(hits.join(named, "rep").withColumn("_n", F.row_number().over(ordered)).filter(F.col("_n") <= k + 1).select("query", "id", "score", "_n"), "nearest")
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score"))).alias("list"))
    own = F.filter("list", lambda x: x["id"] != F.col("query_id"))
    return (
        asked.join(lists, "query")
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
