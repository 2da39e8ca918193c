"""Running maxima over groups that are too large for one task."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from triploom import longest_chains, successor_edges, trip_chains, trip_vertices
from triploom.operators import scan
from triploom.operators.scan import running_max


def test_running_max_over_pieces(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, rng.randrange(1000)])) for i in range(600)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "key string, at int, value int").repartition(7)
    expected, most = {}, {}
    for key, at, value in sorted(rows, key=lambda r: r[1]):
        if value is not None:
            most[key] = max(most.get(key, value), value)
        expected[at] = most.get(key)
    found = running_max(frame, ["key"], ["at"], "value")
    assert {r["at"]: r["best"] for r in found.collect()} == expected
    assert running_max(frame.limit(0), ["key"], ["at"], "value").collect() == []


def test_pieces_of_one_group_are_even(spark, monkeypatch):
    """A key with a third of all rows, all within a moment, is dealt out like any other."""
    held = []
    cut = scan.cut_lineage
    monkeypatch.setattr(scan, "cut_lineage", lambda df: held.append(cut(df)) or held[-1])
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1).alias("place"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("time"),
        (F.col("id") % 31).alias("value"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        running_max(rows, ["place"], ["time"], "value").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = sorted(r["count"] for r in held[0].groupBy("_piece").count().collect())
    assert len(sizes) == 16
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.mark.parametrize(("strategy", "cell_rows"), [("blocked", 12), ("frontier", 0)])
def test_chains_through_a_hot_place(spark, strategy, cell_rows):
    """A third of all trips start and end at one place; the result is that of the edges."""
    rng = random.Random(7)
    start = datetime(2021, 5, 1)
    rows = []
    for i in range(110):
        places = [0 if rng.random() < 0.35 else rng.randrange(1, 6) for _ in range(2)]
        begin = start + timedelta(seconds=rng.randrange(200) + rng.choice([0, 0.25]))
        end = begin + timedelta(seconds=rng.randrange(1, 40))
        rows.append((i, begin, end, *places, float(rng.randint(0, 6))))
    names = "tripId long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, trip_distance double"
    trips = spark.createDataFrame(rows, names)
    direct = trip_chains(trips, 25, strategy=strategy, cell_rows=cell_rows, block_rows=40)
    edges = longest_chains(trip_vertices(trips), successor_edges(trips, 25))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, edges.collect()))
