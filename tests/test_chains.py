import random
from datetime import datetime, timedelta, timezone

import pytest
from fixtures import EDGES, TRIP_EDGES, TRIP_ROWS, TRIP_SCHEMA, VERTEX_WEIGHTS
from pyspark.sql import functions as F

from triploom import (
    assemble_graph,
    chain_paths,
    chain_text,
    longest_chains,
    successor_edges,
    trip_chains,
    trip_vertices,
    with_trip_id,
)

TIMED = (
    "tripId long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "PULocationID int, DOLocationID int, trip_distance double"
)


@pytest.fixture(scope="module")
def graph(spark):
    vertices = spark.createDataFrame(
        list(enumerate(VERTEX_WEIGHTS)), "tripId long, weight double"
    )
    return vertices, spark.createDataFrame(EDGES, "src long, dst long")


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(TRIP_ROWS, TRIP_SCHEMA)


def as_dict(df):
    return {r["tripID"]: (r["longestDistance"], r["previousTripID"]) for r in df.collect()}


def edge_set(df):
    rows = [(r["src"], r["dst"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_published_graph_by_distance(graph):
    result = longest_chains(*graph)
    sums = {k: v[0] for k, v in as_dict(result).items()}
    assert max(sums.values()) == 89.0
    assert [sums[v] for v in (15, 21, 3, 20, 13)] == [89.0, 81.0, 71.0, 69.0, 66.0]
    text = chain_text(chain_paths(result)).collect()
    assert [r["path"] for r in text] == ["10 > 11 > 12 > 13 > 15"]


def test_published_graph_by_trips(graph):
    result = longest_chains(*graph, weight="count")
    assert max(v[0] for v in as_dict(result).values()) == 6.0
    text = chain_text(chain_paths(result)).collect()
    assert [r["path"] for r in text] == ["16 > 19 > 17 > 18 > 20 > 21"]


def test_paths_of_several_chains(graph):
    paths = chain_paths(longest_chains(*graph), k=3).orderBy("chain", "position").collect()
    assert [r["tripID"] for r in paths if r["chain"] == 1] == [10, 11, 12, 13, 15]
    assert [r["tripID"] for r in paths if r["chain"] == 2] == [16, 19, 17, 18, 20, 21]
    assert [r["position"] for r in paths if r["chain"] == 3] == [1, 2, 3, 4]


@pytest.mark.parametrize("strategy", ["blocked", "frontier"])
def test_published_trips(trips, strategy):
    assert edge_set(successor_edges(trips)) == TRIP_EDGES
    result = as_dict(trip_chains(trips, strategy=strategy))
    assert max(v[0] for v in result.values()) == 20.7
    assert result[17] == (20.7, 17)
    assert result[30] == (pytest.approx(9.83), 29)
    counts = as_dict(trip_chains(trips, weight="count", strategy=strategy))
    assert max(v[0] for v in counts.values()) == 2.0
    assert {k for k, v in counts.items() if v[0] == 2.0} == {b for _, b in TRIP_EDGES}


def test_missing_vertices_weigh_nothing(spark):
    vertices = spark.createDataFrame([(1, 2.0)], "tripId long, weight double")
    edges = spark.createDataFrame([(1, 2), (3, 1)], "src long, dst long")
    assert {(r["id"], r["weight"]) for r in assemble_graph(vertices, edges).collect()} == {
        (1, 2.0), (2, 0.0), (3, 0.0),
    }
    # 3 weighs nothing, so it adds nothing and is nobody's predecessor
    assert as_dict(longest_chains(vertices, edges)) == {1: (2.0, 1), 2: (2.0, 1), 3: (0.0, 3)}
    assert as_dict(longest_chains(vertices, edges, "count"))[2] == (3.0, 1)


def test_rounds_have_no_limit_but_the_callers(spark):
    vertices = spark.createDataFrame([(i, 1.0) for i in range(24)], "tripId long, weight double")
    edges = spark.createDataFrame([(i, i + 1) for i in range(23)], "src long, dst long")
    assert as_dict(longest_chains(vertices, edges))[23] == (24.0, 22)
    with pytest.raises(RuntimeError, match="max_rounds=3"):
        longest_chains(vertices, edges, max_rounds=3)


def test_null_distances_weigh_nothing_and_link(spark):
    vertices = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "tripId long, trip_distance double")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    graph = trip_vertices(vertices)
    assert as_dict(longest_chains(graph, edges)) == {1: (5.0, 1), 2: (5.0, 1), 3: (12.0, 2)}


def test_cycles_raise(spark):
    vertices = spark.createDataFrame([(1, 2.0), (2, 1.0)], "tripId long, weight double")
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    with pytest.raises(RuntimeError, match="cycle"):
        longest_chains(vertices, edges)


def test_bad_arguments(trips):
    with pytest.raises(ValueError):
        successor_edges(trips, 0)
    with pytest.raises(ValueError):
        successor_edges(trips, invalid_trips="drop")
    with pytest.raises(ValueError):
        trip_chains(trips, weight="time")
    with pytest.raises(ValueError):
        trip_chains(trips, strategy="pregel")


def test_trip_ids(trips):
    given = with_trip_id(trips.withColumnRenamed("tripId", "key"), "key")
    assert {r["tripId"] for r in given.collect()} == {r[0] for r in TRIP_ROWS}
    made = with_trip_id(trips.drop("tripId"))
    assert made.select("tripId").distinct().count() == len(TRIP_ROWS)


EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def random_trips(seed, count, places, span_s, sub_second=True):
    """Trips with NULLs, negative durations, zero distances and a hot first place."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        start = rng.uniform(0, span_s) if sub_second else rng.randrange(span_s)
        length = rng.choice([rng.randint(-5, 0), rng.randint(1, 40), rng.randint(1, 40)])
        pickup = EPOCH + timedelta(seconds=start)
        dropoff = pickup + timedelta(seconds=length)
        place = lambda: rng.choice([None, 0, 0, *range(places)])
        rows.append(
            (
                i,
                None if rng.random() < 0.03 else pickup,
                None if rng.random() < 0.03 else dropoff,
                place(),
                place(),
                None if rng.random() < 0.03 else float(rng.choice([0, 1, 2, 2.5, 7.25])),
            )
        )
    return rows


def micros(moment):
    return round((moment - EPOCH) / timedelta(microseconds=1))


def brute_edges(rows, max_idle):
    in_order = [r for r in rows if not (r[1] and r[2] and r[2] < r[1])]
    return {
        (a[0], b[0])
        for a in in_order
        for b in in_order
        if a[2] and b[1] and a[4] is not None and a[4] == b[3] and a[2] < b[1]
        and micros(b[1]) // 1_000_000 - micros(a[2]) // 1_000_000 < max_idle
    }


def brute_chains(rows, edges, weight):
    known = {r[0]: ((r[5] or 0.0) if weight == "distance" else 1.0) for r in rows}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or EPOCH))
    fathers = {}
    for a, b in edges:
        fathers.setdefault(b, []).append(a)
    result = {}
    for row in order:
        v = row[0]
        offers = [(-result[u][0], u) for u in fathers.get(v, [])]
        best = min(offers, default=(0.0, v))
        result[v] = (known[v] - best[0], best[1]) if best[0] < 0 else (known[v], v)
    return result


@pytest.mark.parametrize(
    ("seed", "max_idle", "sub_second"), [(1, 30, True), (3, 7.5, False)]
)
def test_against_brute_force(spark, seed, max_idle, sub_second):
    rows = random_trips(seed, 110, 4, 160, sub_second)
    df = spark.createDataFrame(rows, TIMED)
    edges = brute_edges(rows, max_idle)
    assert edge_set(successor_edges(df, max_idle)) == edges
    assert edge_set(successor_edges(df, max_idle, hot_rows=3)) == edges

    expected = brute_chains(rows, edges, "distance")
    graph = longest_chains(trip_vertices(df), successor_edges(df, max_idle))
    assert as_dict(graph) == expected
    for options in (
        {"strategy": "frontier"},
        {"strategy": "blocked", "block_rows": 20, "wave": 2},
        {"strategy": "blocked", "block_rows": 3, "hot_rows": 1, "broadcast_rows": 0},
    ):
        assert as_dict(trip_chains(df, max_idle, **options)) == expected, options


def test_counts_against_brute_force(spark):
    rows = random_trips(5, 100, 3, 130, sub_second=False)
    df = spark.createDataFrame(rows, TIMED)
    expected = brute_chains(rows, brute_edges(rows, 25), "count")
    assert as_dict(trip_chains(df, 25, "count", block_rows=25)) == expected
    frontier = trip_chains(
        df, 25, "count", strategy="frontier", hot_rows=2, broadcast_rows=0
    )
    assert as_dict(frontier) == expected


def test_rounds_do_not_grow_with_the_slabs(spark):
    """A chain of 400 trips crosses some 40 slabs, but no more zones than tasks are for."""
    def at(s: int):
        return EPOCH + timedelta(seconds=s)

    rows = [(i, at(10 * i), at(10 * i + 5), i % 7, (i + 1) % 7, 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, TIMED)
    rounds = 2 * spark.sparkContext.defaultParallelism + 4
    got = as_dict(trip_chains(df, 30, block_rows=20, max_rounds=rounds))
    assert got == {i: (i + 1.0, max(i - 1, 0)) for i in range(400)}


def test_hot_sources_are_salted(spark):
    """One vertex holds a third of the edges; the result must not change."""
    edges = [(0, v) for v in range(1, 60)] + [(v, v + 100) for v in range(1, 60)]
    vertices = [(v, 1.0) for v in sorted({v for e in edges for v in e})]
    result = longest_chains(
        spark.createDataFrame(vertices, "tripId long, weight double"),
        spark.createDataFrame(edges, "src long, dst long"),
        hot_rows=7,
        broadcast_rows=0,
    )
    got = as_dict(result)
    assert got[0] == (1.0, 0)
    assert all(got[v] == (2.0, 0) and got[v + 100] == (3.0, v) for v in range(1, 60))


def test_negative_durations_may_be_kept(spark):
    start = EPOCH + timedelta(seconds=100)
    rows = [
        (1, start, start - timedelta(seconds=20), 5, 6, 1.0),
        (2, start, start + timedelta(seconds=9), 6, 7, 1.0),
    ]
    df = spark.createDataFrame(rows, TIMED)
    assert edge_set(successor_edges(df)) == set()
    assert edge_set(successor_edges(df, invalid_trips="keep")) == {(1, 2)}
    assert as_dict(trip_chains(df))[2] == (1.0, 2)
    assert as_dict(trip_chains(df, invalid_trips="keep"))[2] == (2.0, 1)


def test_self_following_trip_raises_when_kept(spark):
    start = EPOCH + timedelta(seconds=100)
    rows = [(1, start, start - timedelta(seconds=20), 5, 5, 1.0)]
    df = spark.createDataFrame(rows, TIMED)
    assert as_dict(trip_chains(df)) == {1: (1.0, 1)}
    with pytest.raises(Exception, match="cycle"):
        trip_chains(df, invalid_trips="keep")


def test_places_may_be_text(spark):
    rows = [(r[0], *r[1:3], None if r[3] is None else f"p{r[3]}", None if r[4] is None else f"p{r[4]}", r[5])
            for r in random_trips(8, 80, 3, 200)]
    df = spark.createDataFrame(rows, TIMED.replace("ID int", "ID string"))
    expected = brute_chains(rows, brute_edges(rows, 30), "distance")
    assert as_dict(trip_chains(df, 30, block_rows=20)) == expected


def test_integer_times(spark):
    """The small file with plain numbers for times: pairs linked by place and time."""
    rows = [(1, 2, 10, 100, 110), (2, 3, 16, 111, 120), (2, 3, 20, 90, 115),
            (1, 3, 25, 100, 110), (3, 1, 7, 121, 125)]
    names = "PULocationID int, DOLocationID int, trip_distance int, tpep_pickup_datetime int, tpep_dropoff_datetime int"
    df = spark.createDataFrame(rows, names).withColumn(
        "tripId", F.col("trip_distance").cast("long")
    )
    assert edge_set(successor_edges(df)) == {(10, 16), (16, 7), (20, 7), (25, 7)}
    assert as_dict(trip_chains(df))[7] == (33.0, 16)
