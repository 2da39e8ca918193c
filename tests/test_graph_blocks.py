"""Chains over any graph: contraction of runs, blocks of edges, edge weights."""

import random

import numpy as np
import pytest

from triploom import chain_paths, longest_chains, read_edges, read_vertices
from triploom.operators import contraction, graph_blocks
from triploom.operators.graph_blocks import settled


def chains_of(rows):
    return {r["tripID"]: (r["longestDistance"], r["previousTripID"]) for r in rows.collect()}


def frames(spark, weights, edges):
    vertices = spark.createDataFrame(sorted(weights.items()), "tripId long, weight double")
    return vertices, spark.createDataFrame(edges, "src long, dst long, nb double")


def brute(weights, edges):
    """Best sums by repeated passes over all edges, and the smallest best predecessor."""
    cum = dict.fromkeys(weights, 0.0)
    for _ in range(len(weights) + 1):
        changed = False
        for s, d, n in edges:
            offer = weights[s] + (n or 0.0) + cum[s]
            if offer > cum[d]:
                cum[d], changed = offer, True
        if not changed:
            break
    else:
        raise RuntimeError("cycle")
    father = {}
    for s, d, n in edges:
        offer = weights[s] + (n or 0.0) + cum[s]
        if offer > 0:
            father[d] = min(father.get(d, (0.0, d)), (-offer, s))
    return {v: (weights[v] + cum[v], father.get(v, (0.0, v))[1]) for v in weights}


def random_graph(seed, n, m, back=False):
    """Runs, diamonds and random edges from smaller to larger ids (shuffled if ``back``)."""
    rng = random.Random(seed)
    names = list(range(n))
    if back:
        rng.shuffle(names)
    edges = set()
    for _ in range(m):
        s = rng.randrange(n - 1)
        edges.add((s, min(n - 1, s + rng.choice([1, 1, 1, 2, 5, 40]))))
    edges |= {(s, s + 1) for s in range(0, n - 1) if rng.random() < 0.5}
    weights = {v: float(rng.choice([0, 1, 1, 2, 3, -1, 7])) for v in range(n)}
    rows = [(names[s], names[d], rng.choice([0.0, 1.0, -2.0, None])) for s, d in edges if s != d]
    return {names[v]: w for v, w in weights.items()}, rows


@pytest.mark.parametrize(("back", "options"), [(True, {}), (False, {"block_rows": 25}), (True, {"block_rows": 12, "hot_rows": 2, "broadcast_rows": 0})])
def test_contracted_equals_brute_force(spark, back, options):
    weights, edges = random_graph(3 + back, 160, 120, back)
    vertices, frame = frames(spark, weights, edges)
    plain = [(s, d, 0.0) for s, d, _ in edges]
    assert chains_of(longest_chains(vertices, frame, **options)) == brute(weights, plain)
    weighted = longest_chains(vertices, frame, edge_weight="nb", **options)
    assert chains_of(weighted) == brute(weights, edges)


def test_both_strategies_agree(spark):
    weights, edges = random_graph(9, 90, 80)
    vertices, frame = frames(spark, weights, edges)
    one = longest_chains(vertices, frame, "count", strategy="frontier", edge_weight="nb")
    two = longest_chains(vertices, frame, "count", block_rows=10, edge_weight="nb")
    assert chains_of(one) == chains_of(two)
    with pytest.raises(ValueError, match="strategy"):
        longest_chains(vertices, frame, strategy="pregel")


def test_long_path_takes_logarithmic_rounds(spark, monkeypatch):
    n, written = 10_000, []
    for module in (contraction, graph_blocks):
        cut = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, cut=cut: written.append(1) or cut(df))
    vertices = spark.range(n).selectExpr("id AS tripId", "cast(id % 7 + 1 AS double) AS weight")
    edges = spark.range(n - 1).selectExpr("id AS src", "id + 1 AS dst")
    found = chains_of(longest_chains(vertices, edges, block_rows=500))
    sums = np.cumsum(np.arange(n) % 7 + 1.0)
    assert found == {i: (sums[i], max(i - 1, 0)) for i in range(n)}
    assert len(written) <= 25


def test_diamond_mesh(spark):
    """A grid whose every vertex has two predecessors: nothing to contract, deep and wide."""
    side = 60
    rng = random.Random(4)
    weights = {r * side + c: float(rng.randint(1, 9)) for r in range(side) for c in range(side)}
    edges = [(v, v + 1, 0.0) for v in weights if v % side < side - 1]
    edges += [(v, v + side, 0.0) for v in weights if v < side * (side - 1)]
    vertices, frame = frames(spark, weights, edges)
    expected = {}
    for v in sorted(weights):
        offers = [(-expected[p][0], p) for p in (v - 1, v - side) if p >= 0 and (p == v - side or v % side)]
        best = min(offers, default=(0.0, v))
        expected[v] = (weights[v] - best[0], best[1])
    assert chains_of(longest_chains(vertices, frame, block_rows=2_000)) == expected


def test_one_source_of_a_third_of_all_edges(spark):
    edges = [(0, v, 1.0) for v in range(1, 400)] + [(v, v + 1_000, None) for v in range(1, 400)]
    edges += [(v + 1_000, 5_000, 0.0) for v in range(1, 400)]
    weights = {v: 1.0 for e in edges for v in e[:2]}
    vertices, frame = frames(spark, weights, edges)
    found = longest_chains(vertices, frame, edge_weight="nb", block_rows=50, hot_rows=20, broadcast_rows=0)
    assert chains_of(found) == brute(weights, edges)


def test_circles(spark):
    """A circle that gains nothing is no harm; one that gains raises, contracted or not."""
    weights = {v: 0.0 for v in range(40)} | {100: 1.0}
    edges = [(v, (v + 1) % 40, 0.0) for v in range(40)] + [(100, 0, 0.0)]
    vertices, frame = frames(spark, weights, edges)
    for block_rows in (10, 1_000):
        found = chains_of(longest_chains(vertices, frame, block_rows=block_rows))
        assert all(found[v][0] == 1.0 for v in range(40))
        with pytest.raises(RuntimeError, match="cycle"):
            longest_chains(vertices, frame, "count", block_rows=block_rows)
        lossy = [(s, d, 1.0 if s % 2 else -0.5) for s, d, _ in edges]
        with pytest.raises(RuntimeError, match="cycle"):
            longest_chains(*frames(spark, weights, lossy), edge_weight="nb", block_rows=block_rows)


def test_empty_and_odd_edges(spark):
    vertices, none = frames(spark, {1: 2.0, 2: 3.0}, [])
    assert chains_of(longest_chains(vertices, none)) == {1: (2.0, 1), 2: (3.0, 2)}
    _, twice = frames(spark, {1: 2.0}, [(1, 2, 1.0), (1, 2, 4.0), (1, 2, 4.0)])
    for block_rows in (1, 100):
        assert chains_of(longest_chains(vertices, twice, edge_weight="nb", block_rows=block_rows)) == {1: (2.0, 1), 2: (9.0, 1)}


def test_settled_block_against_passes():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n, m = int(rng.integers(2, 30)), int(rng.integers(1, 60))
        src = rng.integers(0, n - 1, m)
        dst = np.minimum(src + rng.integers(1, 6, m), n - 1)
        a = rng.integers(-3, 6, m).astype(float)
        b = np.where(rng.random(m) < 0.5, -np.inf, rng.integers(-2, 4, m).astype(float))
        known = rng.integers(0, 5, n).astype(float)
        expected = known.copy()
        for _ in range(n + 1):
            np.maximum.at(expected, dst, np.maximum(b, a + expected[src]))
        assert settled(src, dst, a, b, known, 1e9).tolist() == expected.tolist()


def test_edge_attribute_is_read(spark, tmp_path):
    for name, text in (("v.csv", "tripId,trip_distance\n0,1.5\n1,2.0\n"), ("e.csv", "tripA,tripB,nb\n0,1,4\n")):
        (tmp_path / name).write_text(text)
    edges = read_edges(spark, str(tmp_path / "e.csv"), "nb")
    assert [tuple(r) for r in edges.collect()] == [(0, 1, 4.0)]
    vertices = read_vertices(spark, str(tmp_path / "v.csv"))
    assert chains_of(longest_chains(vertices, edges, edge_weight="nb")) == {0: (1.5, 0), 1: (7.5, 0)}
    with pytest.raises(ValueError, match="third column"):
        read_edges(spark, str(tmp_path / "v.csv"), "nb")


@pytest.mark.parametrize("block_rows", [0, 1_000])
def test_paths_by_either_way(spark, block_rows):
    """One task walks back along few links, more are squared."""
    rows = [(i, float(i % 50), i if i % 50 == 0 else i - 1) for i in range(150)]
    result = spark.createDataFrame(rows, "tripID long, longestDistance double, previousTripID long")
    paths = chain_paths(result, k=2, block_rows=block_rows).orderBy("chain", "position").collect()
    assert [tuple(r) for r in paths] == [(c, p, 50 * (c - 1) + p - 1) for c in (1, 2) for p in range(1, 51)]
    assert chain_paths(result.limit(0), block_rows=block_rows).collect() == []
    ring = spark.createDataFrame([(i, 1.0, (i + 1) % 5) for i in range(5)], result.schema)
    with pytest.raises(RuntimeError, match="cycle"):
        chain_paths(ring, block_rows=block_rows).collect()
