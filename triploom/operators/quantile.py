"""Exact distributed quantile and the labels cut at it."""

from __future__ import annotations

import math
import struct

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.sources.checkpoints import cut_lineage

BINS = 4096
SKETCH = 4096


def exact_quantile(
    df: DataFrame, column: str, q: float, bins: int = BINS, sketch: int = SKETCH
) -> float | None:
    """Smallest value at or below which a share of at least ``q`` of the rows lies.

    Two passes over the values: one builds a mergeable sketch with ``sketch`` items a level,
    whose quantiles a little below and above ``q`` bracket the wanted value; the other counts
    what lies below the bracket and how often each value inside it occurs. Ties cost one row
    each, and the counts, a few rows of a thousand, hold the answer. Should the bracket miss
    it, which the sketch's error makes improbable, all values are searched as below.
    NULL and NaN are left out; both zeros are one value. Only the values are kept between the
    passes, so ``df`` itself is computed once.
    """
    values = df.select((F.col(column).cast("double") + F.lit(0.0)).alias("x"))
    values = values.filter("x is not null and not isnan(x)").persist()
    try:
        count, bracket = _bracket(values, q, sketch)
        if count == 0:
            return None
        rank = min(max(math.ceil(q * count), 1), count)
        inside = F.when(F.col("x") >= bracket[0], F.col("x"))
        counts = values.filter(F.col("x") <= bracket[1]).groupBy(inside.alias("x"))
        counts = cut_lineage(counts.agg(F.count(F.lit(1)).alias("n")))
        below = counts.filter("x is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        held = counts.filter("x is not null")
        found = _find_rank(held, rank - below, bins)
        return _find_rank(values.withColumn("n", F.lit(1)), rank, bins) if found is None else found
    finally:
        values.unpersist()


def _bracket(values: DataFrame, q: float, sketch: int) -> tuple[int, tuple[float, float]]:
    """The number of values, and two between which the ``q``-quantile almost surely lies.

    The margin is three times the rank error that the sketch keeps to in 99 of 100 cases.
    """
    margin = 3 * 2.3 / sketch**0.9
    made = values.agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", F.lit(sketch)).alias("s"))
    low, high = (
        F.kll_sketch_get_quantile_double("s", F.lit(min(max(share, 0.0), 1.0)))
        for share in (q - margin, q + margin)
    )
    some = F.col("n") > 0
    count, first, last = made.select("n", F.when(some, low), F.when(some, high)).first()
    # beyond the ends of the ranks the sketch says nothing
    first, last = -math.inf if q <= margin else first, math.inf if q >= 1 - margin else last
    return count, (first, last)


def order_key(value: float) -> int:
    """The place of a double among all doubles; both zeros are 0."""
    bits = struct.unpack("<q", struct.pack("<d", value))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def from_order_key(key: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return value if key >= 0 else -value


def _find_rank(values: DataFrame, rank: int, bins: int) -> float | None:
    """The value of ``rank`` (from 1) among ``x``, each of which occurs ``n`` times; None if out of range.

    Few values are looked through by the driver. Of more, each pass counts ``bins`` ranges
    and keeps the one with the wanted rank, until it holds a single value. The ranges are
    equally wide in the order of the doubles' bits, of which a pass settles twelve: six passes
    at most for any values, infinities included. The driver sees at most ``bins`` rows.
    """
    total, low, high = values.agg(F.sum("n"), F.min("x"), F.max("x")).first()
    if total is None or not 1 <= rank <= total:
        return None
    first, last = order_key(low), order_key(high)
    while first < last:
        width = -(-(last - first + 1) // bins)
        starts = [from_order_key(k) for k in range(first, last + 1, width)]
        inside = values.filter(F.col("x").between(from_order_key(first), from_order_key(last)))
        few = inside.limit(bins + 1).collect()
        if len(few) <= bins:
            for part in sorted(few, key=lambda r: r["x"]):
                if rank <= part["n"]:
                    return part["x"]
                rank -= part["n"]
        cut = Bucketizer(splits=[*starts, math.inf] if starts[-1] < math.inf else starts, inputCol="x", outputCol="bin")
        ranges = cut.transform(inside).groupBy("bin").agg(
            F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        for part in sorted(ranges.collect(), key=lambda r: r["bin"]):  # at most `bins` rows
            if rank <= part["n"]:
                first, last = order_key(part["low"]), order_key(part["high"])
                break
            rank -= part["n"]
    return from_order_key(first)


def outlier_threshold(
    df: DataFrame, score_col: str, contamination: float, exact: bool = True
) -> float:
    """Score above which a ``contamination`` share of the rows lies.

    ``exact=False`` uses Spark's quantile sketch with an error of 1 % of the share; its
    summaries grow with the precision, so the exact form is the better one at scale.
    """
    if not 0.0 < contamination < 1.0:
        raise ValueError("contamination must lie between 0 and 1")
    q = 1.0 - contamination
    if exact:
        threshold = exact_quantile(df, score_col, q)
    else:
        found = df.approxQuantile(score_col, [q], 0.01 * contamination)
        threshold = found[0] if found else None
    if threshold is None:
        raise ValueError("no rows to take the threshold from")
    return threshold


def label_above(
    df: DataFrame, score_col: str, threshold: float, label_col: str = "predictedLabel"
) -> DataFrame:
    """Label 1.0 for scores at or above the threshold, else 0.0.

    A NULL or NaN score counts neither for the threshold nor as an outlier.
    """
    score = F.col(score_col)
    is_outlier = (score >= F.lit(threshold)) & ~F.isnan(score)
    return df.withColumn(label_col, F.when(is_outlier, 1.0).otherwise(0.0))


def label_by_contamination(
    df: DataFrame, score_col: str, contamination: float, exact: bool = True
) -> DataFrame:
    """Label the highest-scored ``contamination`` share of the rows (ties included)."""
    threshold = outlier_threshold(df, score_col, contamination, exact)
    return label_above(df, score_col, threshold)


def outliers(df: DataFrame, label_col: str = "predictedLabel") -> DataFrame:
    return df.filter(F.col(label_col) == 1)


def drop_outliers(df: DataFrame, label_col: str = "predictedLabel") -> DataFrame:
    return df.filter(F.col(label_col) == 0)
