import random

import pytest
from fixtures import NEIGHBOUR_TOTALS, PAIR_ROWS, PAIR_SCHEMA, PAIR_TOTALS

from triploom import neighbour_totals, pair_totals, ranked, top_k
from triploom.operators.pairs import with_halo


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(PAIR_ROWS, PAIR_SCHEMA)


def by_pair(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def test_published_pair_totals(published):
    assert by_pair(pair_totals(published)) == pytest.approx(PAIR_TOTALS)
    exact = by_pair(pair_totals(published, scale=2))
    assert exact == PAIR_TOTALS


def test_struct_key_holds_the_same_sums(published):
    rows = pair_totals(published, key="struct", scale=2).collect()
    assert {tuple(r[0]): r[1] for r in rows} == PAIR_TOTALS
    with pytest.raises(ValueError):
        pair_totals(published, key="other")


def test_published_neighbour_totals(published):
    assert by_pair(neighbour_totals(published)) == pytest.approx(NEIGHBOUR_TOTALS)


def test_ranking_breaks_ties_by_key(published):
    rows = ranked(pair_totals(published, scale=2), "total_amount", ["PULocationID", "DOLocationID"])
    assert [(r[0], r[1]) for r in rows.collect()] == [
        (149, 251), (150, 250), (150, 251), (150, 252), (149, 300),
    ]
    top = top_k(pair_totals(published, scale=2), "total_amount", 3, ["PULocationID", "DOLocationID"])
    assert [(r[0], r[1]) for r in top.collect()] == [(149, 251), (150, 250), (150, 251)]


def brute_force(rows, depth):
    totals = {}
    for pu, do, amount in rows:
        known = totals.setdefault((pu, do), None)
        if amount is not None:
            totals[pu, do] = (known or 0) + amount
    result = {}
    for (pu, do), own in totals.items():
        if own is None or pu is None or do is None:
            result[pu, do] = own
            continue
        around = [
            amount
            for (p, d), amount in totals.items()
            if p is not None and d is not None and amount is not None
            and (p, d) != (pu, do) and abs(p - pu) <= depth and abs(d - do) <= depth
        ]
        result[pu, do] = own + sum(around)
    return result


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 15])
def test_neighbour_totals_match_brute_force(spark, depth):
    rng = random.Random(depth)
    ids = [None, *range(-6, 12)]
    rows = [
        (rng.choice(ids), rng.choice(ids), rng.choice([None, float(rng.randint(-9, 99))]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, PAIR_SCHEMA)
    assert by_pair(neighbour_totals(df, depth)) == brute_force(rows, depth)


@pytest.mark.parametrize(("depth", "block"), [(0, 4), (1, 4), (2, 4), (5, 7), (15, 512)])
def test_squares_match_brute_force(spark, depth, block):
    rng = random.Random(depth + 50)
    ids = [None, *range(-20, 25)]
    rows = [
        (rng.choice(ids), rng.choice(ids), rng.choice([None, rng.randint(-900, 9900) / 4])) for _ in range(500)
    ]
    df = spark.createDataFrame(rows, PAIR_SCHEMA)
    found = by_pair(neighbour_totals(df, depth, scale=2, block=block))
    expected = brute_force(rows, depth)
    assert found.keys() == expected.keys()
    assert all(found[k] == (None if v is None else pytest.approx(v)) for k, v in expected.items())


def test_rows_dont_grow_with_the_depth(spark):
    totals = spark.range(20_000).selectExpr("(id * 7919) % 3000 AS pu", "(id * 104729) % 3000 AS do", "1 AS amount").distinct()
    n = totals.count()
    assert with_halo(totals, 1, 512).count() < 1.02 * n
    assert with_halo(totals, 15, 512).count() < 1.3 * n
    assert with_halo(totals, 900, 1_800).count() <= 4 * n
    assert with_halo(totals, 15, 512).filter("own").count() == n


def test_depth_zero_is_the_plain_total(spark, published):
    assert by_pair(neighbour_totals(published, 0, scale=2)) == PAIR_TOTALS
    with pytest.raises(ValueError):
        neighbour_totals(published, -1)


def test_neighbours_need_two_shuffles_only(published):
    plan = neighbour_totals(published)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert "Join" not in plan
