"""Isolation Forest (Liu, Ting, Zhou: *Isolation Forest*, ICDM 2008) on Spark.

All trees grow at once, level by level, in DataFrame expressions: the range of every feature
in every node is one window a level, and every random number is taken from an MD5 digest, so
the forest depends on the data and the seed alone. A forest has at most ``4 * max_samples``
nodes per tree however large the table is, which is what makes it safe to hold on the driver.
A forest over one feature scores by interval lookup, one over more by a vectorised walk.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triploom.operators.quantile import label_above, outlier_threshold
from triploom.sources.checkpoints import cut_lineage
from triploom.sources.stages import read_stage, write_stage

# executors get the functions below with the task and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329
POOL_FACTOR = 4
#: Path lengths are added as whole multiples of this share, so that any order gives one sum.
PATH_UNITS = 1_000_000_000
HASH_DIGITS = 13
PRIME = (1 << 31) - 1
NODE_SCHEMA = (
    "tree int, node int, feature int, split double, left int, right int, "
    "size int, depth int"
)


def average_path(size: np.ndarray | int) -> np.ndarray:
    """Mean path length c(n) of an unsuccessful search in a binary tree of n keys."""
    n = np.asarray(size, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def uniform(*parts: Column | str | int) -> Column:
    """A number evenly spread over [0, 1): the first 52 bits of the MD5 of ``parts``."""
    text = F.concat_ws(":", *((p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts))
    digits = F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**HASH_DIGITS))


def grow_trees(samples: DataFrame, width: int, max_depth: int, seed: int) -> DataFrame:
    """The nodes (``NODE_SCHEMA``) of all trees over ``samples`` (``tree``, ``x``).

    Nodes are numbered like a heap, the root 1 and the children of ``n`` being ``2 n`` and
    ``2 n + 1``. Each level takes the least and largest value of every feature per node and
    splits the nodes in which one differs, until every point is alone, equal to its group or
    too deep. The points stay dealt out by tree, so no level shuffles.
    """
    points = samples.select("tree", "x", F.lit(1).alias("node"))
    in_node = Window.partitionBy("tree", "node")
    reached = []
    for level in range(max_depth + 1):
        found = {"size": F.count(F.lit(1)).over(in_node).cast("int")}
        feature, split = F.lit(-1), F.lit(0.0)
        if level < max_depth:
            for name, extreme in (("lows", F.min), ("highs", F.max)):
                found[name] = F.array(*(extreme(F.col("x")[i]).over(in_node) for i in range(width)))
        points = points.withColumns(found)
        if level < max_depth:
            wide = [F.when(F.col("lows")[i] < F.col("highs")[i], F.lit(i)) for i in range(width)]
            points = points.withColumn("usable", F.array_compact(F.array(*wide)))
            draw = F.floor(uniform(seed, F.col("tree"), F.col("node"), "feature") * F.size("usable"))
            feature = F.coalesce(F.try_element_at("usable", draw.cast("int") + 1), F.lit(-1))
            points = points.withColumn("feature", feature)
            at = F.greatest(F.col("feature"), F.lit(0))
            points = points.withColumns({"low": F.get("lows", at), "high": F.get("highs", at)})
            share = uniform(seed, F.col("tree"), F.col("node"), "split")
            split = F.col("low") + share * (F.col("high") - F.col("low"))
            # a draw of the minimum itself would separate nothing
            points = points.withColumn("split", F.when(split > F.col("low"), split).otherwise(F.col("high")))
            feature, split = F.col("feature"), F.col("split")
        name = f"level{level}"
        points = points.withColumn(name, F.struct("node", F.lit(level).alias("depth"), feature.alias("feature"), split.alias("split"), "size"))
        reached.append(name)
        if level < max_depth:
            child = 2 * F.col("node") + F.when(F.get("x", at) < F.col("split"), 0).otherwise(1)
            points = points.withColumn("node", F.when(F.col("feature") >= 0, child).otherwise(F.col("node")))
            points = points.select("tree", "x", "node", *reached)
    nodes = points.select("tree", F.explode(F.array(*reached)).alias("n")).groupBy("tree", "n.node")
    # a leaf is met again on every level below it
    nodes = nodes.agg(F.min("n.depth").alias("depth"), F.max("n.feature").alias("feature"), F.max("n.split").alias("split"), F.max("n.size").alias("size"))
    leaf = F.col("feature") < 0
    return nodes.select(
        "tree",
        "node",
        "feature",
        F.when(leaf, 0.0).otherwise(F.col("split")).alias("split"),
        F.when(leaf, -1).otherwise(2 * F.col("node")).alias("left"),
        F.when(leaf, -1).otherwise(2 * F.col("node") + 1).alias("right"),
        "size",
        "depth",
    )


def forest_points(df: DataFrame, id_col: str | None, features_col: str = "features") -> DataFrame:
    """``id`` and the features ``x`` as an array, stored: every later step reads only these."""
    row_id = F.col(id_col) if id_col else F.monotonically_increasing_id()
    return cut_lineage(
        df.select(row_id.alias("id"), vector_to_array(F.col(features_col)).alias("x"))
    )


def forest_samples(
    df: DataFrame, id_col: str | None = None, num_trees: int = 100, max_samples: int = 256, seed: int = 1
) -> DataFrame:
    """The samples that ``fit_isolation_forest`` grows its trees from."""
    points = forest_points(df, id_col)
    return draw_samples(points, points.count(), num_trees, max_samples, seed, POOL_FACTOR)


def tree_factors(seed: int, num_trees: int) -> list[tuple[int, int]]:
    """For each tree the factor and the shift of its order of the rows, from MD5 digests."""
    digests = (hashlib.md5(f"{seed}:{tree}:draw".encode()).hexdigest() for tree in range(num_trees))
    return [(int(d[:8], 16) % (PRIME - 1) + 1, int(d[8:16], 16) % PRIME) for d in digests]


def draw_samples(
    df: DataFrame, rows: int, num_trees: int, max_samples: int, seed: int, pool_factor: int
) -> DataFrame:
    """``max_samples`` rows per tree without replacement, chosen by hashed row id.

    A first hash keeps a pool of a few times the rows the forest needs, so only the
    pool, not the table, is repeated per tree. There every tree orders the rows anew by a
    linear function of their hash modulo a prime; a share leaves each tree about twice its
    sample, of which the lowest are kept.
    """
    pool_size = pool_factor * num_trees * max_samples
    fraction = min(1.0, pool_size / max(rows, 1))
    share = min(1.0, (2 * max_samples + 64) / max(min(rows, pool_size), 1))
    pool = df.filter(uniform(seed, F.col("id")) < fraction)
    # as two strings, since a literal per number would take the driver longer than the draw
    a, b = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>") for x in zip(*tree_factors(seed, num_trees), strict=True))
    hashed = F.floor(uniform(seed, F.col("id"), "hash") * PRIME)
    trees = F.posexplode(F.arrays_zip(a.alias("a"), b.alias("b"))).alias("tree", "f")
    drawn = (
        pool.withColumn("hash", hashed)
        .select("id", "x", "hash", trees)
        .withColumn("draw", (F.col("f.a") * F.col("hash") + F.col("f.b")) % PRIME)
        .filter(F.col("draw") < share * PRIME)
    )
    # a set number of partitions, since the optimizer would join such small ones into one
    # and so grow all trees in one task
    parts = min(num_trees, df.sparkSession.sparkContext.defaultParallelism)
    order = Window.partitionBy("tree").orderBy("draw", "id")
    ranked = drawn.select("tree", "draw", "id", "x").repartition(parts, "tree")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_samples)


def fit_isolation_forest(
    df: DataFrame,
    id_col: str | None = None,
    features_col: str = "features",
    num_trees: int = 100,
    max_samples: int = 256,
    contamination: float = 0.001,
    seed: int = 1,
    exact_threshold: bool = True,
    pool_factor: int = POOL_FACTOR,
) -> ForestModel:
    """Train on a vector column and set the threshold for the outlier share.

    The trees draw their samples from a pool of ``pool_factor`` times the rows that all of
    them need, itself drawn from the whole table; two trees then share rows about as often
    as one in ``pool_factor * num_trees``, at any size above the pool.

    With a unique ``id_col`` the forest depends only on the data and the seed. Without
    one, row numbers from the file layout stand in.
    """
    points = forest_points(df, id_col, features_col)
    rows, width = points.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if rows == 0:
        raise ValueError("cannot train on an empty table")
    sample_size = min(max_samples, rows)
    max_depth = max(int(np.ceil(np.log2(max(sample_size, 2)))), 1)
    samples = draw_samples(points, rows, num_trees, max_samples, seed, pool_factor)
    nodes = grow_trees(samples, width, max_depth, seed).toPandas()  # bounded by the samples
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    model = ForestModel(nodes, sample_size, contamination, None, features_col)
    scores = model.score_values(points, "x")
    model.threshold = outlier_threshold(
        scores, model.score_col, contamination, exact_threshold
    )
    return model


@dataclass
class ForestModel:
    """A trained forest: node table, sample size and outlier threshold."""

    nodes: pd.DataFrame
    sample_size: int
    contamination: float
    threshold: float | None
    features_col: str = "features"
    score_col: str = "outlierScore"
    label_col: str = "predictedLabel"

    def score(self, df: DataFrame) -> DataFrame:
        """Add the outlier score: ``2 ** (-mean path length / c(sample size))``."""
        values = df.withColumn("_x", vector_to_array(F.col(self.features_col)))
        return self.score_values(values, "_x").drop("_x")

    def score_values(self, df: DataFrame, values: str) -> DataFrame:
        """The same for features in an array column.

        With one feature the leaves of all trees cut the line into intervals, each with one
        score: a binary search in their bounds, with no Python worker.
        """
        width = max(int(self.nodes["feature"].max()) + 1, 1)
        if width == 1:
            breaks, scores = self._step_function()
            found = df.withColumn("_first", F.get(F.col(values), F.lit(0)))
            if len(breaks):
                splits = [-np.inf, *breaks.tolist(), np.inf]
                lookup = Bucketizer(splits=splits, inputCol="_first", outputCol="_at", handleInvalid="keep")
                found = lookup.transform(found)
            else:
                found = found.withColumn("_at", F.lit(0.0))
            # NaN has a bucket of its own, which scores like the last one; NULL has no score
            table = F.split(F.lit(",".join(map(repr, [*scores.tolist(), float(scores[-1])]))), ",")
            score = F.get(table.cast("array<double>"), F.col("_at").cast("int"))
            return found.withColumn(self.score_col, score).drop("_first", "_at")
        forest = df.sparkSession.sparkContext.broadcast(self._packed())
        columns = [F.get(F.col(values), F.lit(i)) for i in range(width)]
        return df.withColumn(self.score_col, _score_forest(forest)(*columns))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the outlier score and the label: 1.0 for outliers, else 0.0."""
        return label_above(
            self.score(df), self.score_col, self.threshold, self.label_col
        )

    def save(self, spark: SparkSession, path: str, digest: str | None = None) -> None:
        """Replace ``path`` by the nodes, each with the forest's parameters: one table, one commit."""
        row = {
            "sample_size": F.lit(self.sample_size),
            "contamination": F.lit(self.contamination),
            "threshold": F.lit(self.threshold).cast("double"),
            **{c: F.lit(getattr(self, c)) for c in ("features_col", "score_col", "label_col")},
        }
        nodes = spark.createDataFrame(self.nodes, NODE_SCHEMA)
        write_stage(nodes.withColumns(row).coalesce(1), path, digest)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        """The newest whole forest below ``path``."""
        rows = read_stage(spark, path).toPandas()
        names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]
        nodes = rows[names].sort_values(["tree", "node"], ignore_index=True)
        params = rows.drop(columns=names).iloc[0].to_dict()
        threshold = params.pop("threshold")
        return ForestModel(nodes, threshold=None if pd.isna(threshold) else threshold, **params)

    def _packed(self) -> dict[str, np.ndarray]:
        """All trees as flat arrays; child links become positions in them."""
        nodes = self.nodes
        leaf = nodes["feature"].to_numpy() < 0
        here = np.arange(len(nodes))
        place = pd.Series(here, index=pd.MultiIndex.from_frame(nodes[["tree", "node"]]))
        children = np.column_stack([here, here])
        for side, column in enumerate(("left", "right")):
            ids = pd.MultiIndex.from_arrays([nodes["tree"], nodes[column]])
            children[~leaf, side] = place.reindex(ids[~leaf]).to_numpy()
        path = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())
        return {
            "roots": nodes.groupby("tree").apply(lambda t: t.index[0], include_groups=False).to_numpy(),
            "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
            "split": nodes["split"].to_numpy(),
            "children": children.ravel(),  # a leaf is its own child
            "path": np.rint(path * PATH_UNITS).astype(np.int64),
            "depth": np.array(int(nodes["depth"].max())),
            "norm": np.array(float(average_path(self.sample_size))),
        }

    def _step_function(self) -> tuple[np.ndarray, np.ndarray]:
        """Break points and scores of a forest over one feature."""
        packed = self._packed()
        splits = self.nodes.loc[self.nodes["feature"] >= 0, "split"].to_numpy()
        breaks = np.unique(splits)
        inside = np.concatenate([[-np.inf], breaks])  # the lower end of every step
        return breaks, _walk(packed, inside[:, None])


def _walk(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores of a block of points: all points and trees move down level by level."""
    values, width = np.ascontiguousarray(x).ravel(), x.shape[1]
    row_start = (np.arange(len(x)) * width)[:, None]
    at = np.repeat(forest["roots"][None, :], len(x), axis=0)
    for _ in range(int(forest["depth"])):
        value = values.take(row_start + forest["feature"].take(at))
        goes_right = value >= forest["split"].take(at)
        at = forest["children"].take(2 * at + goes_right)
    mean_path = forest["path"].take(at).sum(axis=1) / (PATH_UNITS * len(forest["roots"]))
    norm = float(forest["norm"])
    return np.power(2.0, -mean_path / norm) if norm > 0 else np.full(len(x), 0.5)


def _score_forest(forest):
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy() for c in columns])
            parts = [_walk(forest.value, x[i : i + 512]) for i in range(0, len(x), 512)]
            yield pd.Series(np.concatenate(parts) if parts else [])

    return score
