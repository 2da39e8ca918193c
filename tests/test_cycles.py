"""Cycles against mutual reach by plain search."""

import random
import sys
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from triploom import cycles, trip_chains, trip_cycles
from triploom.operators import contraction
from triploom.operators.cycles import components


def plain(edges):
    after = defaultdict(set)
    for s, d in edges:
        after[s].add(d)

    def reach(v):
        seen, todo = set(), [v]
        while todo:
            for w in after[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        return seen

    known = {v: reach(v) for v in list(after)}
    rows = set()
    for v, seen in known.items():
        if v in seen:
            rows.add((min(w for w in seen if v in known.get(w, ())), v))
    return rows


def found(frame, **options):
    return {(r["cycle"], r["tripID"]) for r in cycles(frame, **options).collect()}


def graph(seed):
    """Random edges, self loops, circles, a line into a circle and a long line."""
    rng = random.Random(seed)
    edges = [(rng.randrange(25), rng.randrange(25)) for _ in range(32)]
    edges += [(100 + i, 100 + (i + 1) % 9) for i in range(9)]  # a circle that nothing touches
    edges += [(200 + i, 201 + i) for i in range(12)] + [(212, 205), (212, 212)]
    edges += [(300 + i, 301 + i) for i in range(20)] + [(3, 300), (320, 3)]
    rng.shuffle(edges)
    return edges + edges[:5]


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"block_rows": 20}), (3, {"block_rows": 0, "hot_rows": 3})])
def test_cycles_equal_mutual_reach(spark, seed, options):
    edges = graph(seed)
    frame = spark.createDataFrame([*edges, (None, 3), (5, None)], "src long, dst long")
    assert found(frame, **options) == plain(edges)


def test_long_circle_takes_logarithmic_rounds(spark, monkeypatch):
    written = []
    for part in (contraction, sys.modules[cycles.__module__]):
        cut = part.cut_lineage
        monkeypatch.setattr(part, "cut_lineage", lambda df, cut=cut: written.append(1) or cut(df))
    n = 3_000
    edges = spark.range(n).selectExpr("id AS src", f"(id * 7 + 7) % {7 * n} AS dst").selectExpr("src * 7 AS src", "dst")
    rows = cycles(edges, block_rows=100).collect()
    assert {r["cycle"] for r in rows} == {0} and len(rows) == n
    assert len(written) <= 40


def test_no_cycles(spark):
    frame = spark.createDataFrame([(i, i + 1) for i in range(9)], "src long, dst long")
    for block_rows in (2, 100):
        assert found(frame, block_rows=block_rows) == set()
        assert found(frame.limit(0), block_rows=block_rows) == set()


def test_trips_that_close_a_chain_are_named(spark):
    start = datetime(2021, 5, 1)
    s = lambda x: start + timedelta(seconds=x)
    rows = [
        (1, s(100), s(80), 5, 6, 1.0), (2, s(90), s(70), 6, 5, 1.0),  # each ends before the other starts
        (3, s(200), s(180), 7, 7, 1.0), (4, s(300), s(310), 8, 9, 1.0),
    ]
    names = "tripId long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, trip_distance double"
    trips = spark.createDataFrame(rows, names)
    with pytest.raises(Exception, match="cycle"):
        trip_chains(trips, invalid_trips="keep")
    assert {tuple(r) for r in trip_cycles(trips).collect()} == {(1, 1), (1, 2), (3, 3)}


def test_walk_against_mutual_reach():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, m = int(rng.integers(1, 14)), int(rng.integers(1, 30))
        src, dst = rng.integers(0, n, m), rng.integers(0, n, m)
        label = components(src, dst, n)
        joined = {(a, b) for a in range(n) for b in range(n) if a != b and label[a] == label[b]}
        reach = np.eye(n, dtype=bool)
        reach[src, dst] = True
        for _ in range(n):
            reach |= reach @ reach
        assert joined == {(a, b) for a in range(n) for b in range(n) if a != b and reach[a, b] and reach[b, a]}
