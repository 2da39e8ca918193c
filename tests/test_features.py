import math
import random
import statistics

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from triploom import (
    drop_outliers,
    enrich,
    exact_quantile,
    label_by_contamination,
    outliers,
    prepare,
)

SCHEMA = (
    "tpep_pickup_datetime string, tpep_dropoff_datetime string, "
    "trip_distance double, fare_amount double"
)
ROWS = [
    ("2019-09-01 00:06:48", "2019-09-01 00:25:46", 2.0, 13.0),
    ("2019-09-01 00:59:11", "2019-09-01 00:59:15", 0.0, 2.5),
    ("2019-09-01 00:00:00", "2019-09-01 00:00:00", 1.0, 2.5),  # no time passes
    ("2019-09-01 00:10:00", "2019-09-01 00:00:00", 1.0, 2.5),  # backwards
    ("2019-09-01 00:00:00", "2019-09-01 00:10:00", None, 2.5),
    (None, "2019-09-01 00:10:00", 1.0, 2.5),
    ("2019-09-01 00:00:00", "2019-09-01 00:00:10", 5.0, -3.0),
    ("2019-09-01 00:00:00.9", "2019-09-01 00:00:01.1", 5.0, 3.0),  # 1 whole second
]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_enrich(trips):
    rows = [(r["trip_duration"], r["speed"]) for r in enrich(trips).collect()]
    assert rows == [(1138, 0.0017574692442882249), (4, 0.0), (10, 0.5), (1, 5.0)]


def test_enrich_amounts(trips):
    rows = enrich(trips, amounts=True).collect()
    assert [r["amount_per_mile"] for r in rows] == [6.5, 0.6]
    assert [r["amount_per_second"] for r in rows] == [13.0 / 1138, 3.0]


def test_scaling_divides_by_sample_deviation(trips):
    rows = (
        prepare(trips, "speed_distance")
        .select("speed", "trip_distance", vector_to_array("features").alias("x"))
        .collect()
    )
    for position, column in enumerate(["speed", "trip_distance"]):
        deviation = statistics.stdev(r[column] for r in rows)
        for r in rows:
            assert r["x"][position] == pytest.approx(r[column] / deviation)
    assert len(prepare(trips, ["speed"]).first()["features"]) == 1
    assert len(prepare(trips, "amounts").first()["features"]) == 3
    with pytest.raises(ValueError):
        prepare(trips, "everything")


@pytest.mark.parametrize("q", [0.0, 0.001, 0.5, 0.9, 0.999, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(7)
    values = [rng.choice([rng.gauss(0, 1e3), 0.125, -4.0]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    expected = sorted(values)[max(math.ceil(q * len(values)), 1) - 1]
    assert exact_quantile(df, "x", q) == expected
    assert exact_quantile(df, "x", q, bins=2) == expected


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "x double"), "x", 0.5) is None
    with pytest.raises(ValueError):
        label_by_contamination(spark.createDataFrame([], "x double"), "x", 0.1)


def test_labels_include_ties(spark):
    df = spark.createDataFrame([(float(min(i, 97)),) for i in range(100)], "x double")
    labelled = label_by_contamination(df, "x", 0.01)
    assert {r["x"] for r in outliers(labelled).collect()} == {97.0}
    assert outliers(labelled).count() == 3
    assert drop_outliers(labelled).count() == 97
    rough = label_by_contamination(df, "x", 0.25, exact=False)
    assert outliers(rough).agg(F.min("x")).first()[0] == pytest.approx(74, abs=1)
    with pytest.raises(ValueError):
        label_by_contamination(df, "x", 0.0)
