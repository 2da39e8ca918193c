import math
import random

import pytest

from triploom.operators import quantile
from triploom.operators.quantile import exact_quantile, from_order_key, label_above, order_key


@pytest.mark.parametrize(
    "values",
    [
        [-1.7e308, 0.0, 1.7e308],
        [10.0 ** (i - 300) for i in range(601)],
        [-math.inf, -1.0, -0.0, 0.0, 2.0, math.inf, math.inf],
        [5.0] * 40,
        [random.Random(1).gauss(0, 1) for _ in range(500)],
    ],
)
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.999, 1.0])
def test_quantile_of_any_doubles(spark, values, q):
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double").coalesce(2)
    rank = min(max(math.ceil(q * len(values)), 1), len(values))
    assert exact_quantile(df, "x", q) == sorted(values)[rank - 1]


@pytest.mark.parametrize("q", [0.001, 0.3, 0.5, 0.7, 0.999])
def test_heavy_ties_and_many_values(spark, q):
    """A third of the rows ties at one value, which may be the answer or lie beside it."""
    rng = random.Random(6)
    values = [rng.gauss(0, 1) for _ in range(12_000)] + [0.25] * 6_000
    df = spark.createDataFrame([(v,) for v in values], "x double")
    expected = sorted(values)[math.ceil(q * len(values)) - 1]
    assert exact_quantile(df, "x", q) == expected
    # a coarse sketch, few bins
    assert exact_quantile(df, "x", q, bins=16, sketch=64) == expected


def test_two_passes_over_the_values(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(quantile, "_find_rank", lambda held, rank, bins, f=quantile._find_rank: counted.append(held.count()) or f(held, rank, bins))
    df = spark.range(60_000).selectExpr("cast((id * 7919) % 60000 as double) AS x")
    assert exact_quantile(df, "x", 0.5) == 29_999.0
    assert len(counted) == 1 and counted[0] < 0.02 * 60_000


def test_a_bracket_that_misses_is_noticed(spark, monkeypatch):
    df = spark.range(100).selectExpr("cast(id as double) AS x")
    for bracket in ((90.0, 95.0), (2.0, 4.0)):
        monkeypatch.setattr(quantile, "_bracket", lambda *_, b=bracket: (100, b))
        assert exact_quantile(df, "x", 0.5) == 49.0


def test_order_keys_keep_the_order():
    values = [-math.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1e300, math.inf]
    keys = [order_key(v) for v in values]
    assert keys == sorted(keys)
    assert [from_order_key(k) for k in keys] == values
    assert order_key(-0.0) == order_key(0.0) == 0


def test_missing_scores_are_no_outliers(spark):
    df = spark.createDataFrame([(1, math.nan), (2, None), (3, 0.9)], "id long, score double")
    labels = {r["id"]: r["predictedLabel"] for r in label_above(df, "score", 0.5).collect()}
    assert labels == {1: 0.0, 2: 0.0, 3: 1.0}
