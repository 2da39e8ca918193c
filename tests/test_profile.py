import statistics

import pytest
from pyspark.sql import functions as F

from triploom import (
    count_by,
    count_rows,
    positive_average,
    rows_with_nulls,
    summarize,
    top_locations,
    top_paths,
    totals,
    with_location,
)

SCHEMA = "PULocationID int, DOLocationID int, passenger_count int, total_amount double, flag string"
ROWS = [
    (1, 2, 1, 10.004, "N"),
    (1, 2, 0, 5.001, "N"),
    (1, 3, None, -2.0, None),
    (2, 1, 3, 4.0, "Y"),
    (None, 1, 4, 1.5, "N"),
    (9, 1, 2, 1.5, "N"),
]
LOCATIONS = [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", "Jamaica Bay", "Boro Zone"), (3, "Bronx", "NA", "N/A")]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def locations(spark):
    return spark.createDataFrame(
        LOCATIONS, "LocationID int, Borough string, Zone string, service_zone string"
    )


def test_summary_rows(trips):
    rows = {r["column"]: r for r in summarize(trips, ["passenger_count", "total_amount"]).collect()}
    amounts = [r[3] for r in ROWS]
    assert rows["passenger_count"]["count"] == 5
    assert rows["total_amount"]["mean"] == pytest.approx(statistics.mean(amounts))
    assert rows["total_amount"]["stddev"] == pytest.approx(statistics.stdev(amounts))
    assert (rows["total_amount"]["min"], rows["total_amount"]["max"]) == (-2.0, 10.004)


def test_summary_takes_one_pass(trips):
    plan = summarize(trips)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_describe_layout_covers_text(trips):
    rows = {r["summary"]: r for r in summarize(trips, layout="describe").collect()}
    assert rows["count"]["flag"] == "5"
    assert rows["max"]["flag"] == "Y"
    assert rows["mean"]["flag"] is None
    with pytest.raises(ValueError):
        summarize(trips, ["flag"])
    with pytest.raises(ValueError):
        summarize(trips, layout="wide")


def test_null_rows(trips):
    assert rows_with_nulls(trips, ["passenger_count", "flag"]).count() == 1
    assert rows_with_nulls(trips, ["PULocationID", "flag"]).count() == 2


def test_totals_and_average(trips):
    assert totals(trips, ["total_amount"]).first()[0] == 20.01
    assert positive_average(trips).first()[0] == 2.5
    assert positive_average(trips.filter("passenger_count = 0")).first()[0] is None


def test_counts_keep_null_keys(trips):
    counts = {r[0]: r[1] for r in count_by(trips, "PULocationID").collect()}
    assert counts == {1: 3, 2: 1, None: 1, 9: 1}
    assert count_rows(trips.filter(F.col("flag") == "N")).first()[0] == 4


def test_top_locations(trips, locations):
    top = [tuple(r) for r in top_locations(trips, locations, "PULocationID", 3).collect()]
    assert top == [
        (1, 3, "Newark Airport", "EWR"),
        (None, 1, None, None),
        (2, 1, "Jamaica Bay", "Queens"),
    ]


def test_top_paths(trips, locations):
    pairs = count_by(trips, ["PULocationID", "DOLocationID"])
    best = top_paths(pairs, locations, 1).first()
    assert best.asDict() == {
        "PULocationID": 1, "DOLocationID": 2, "count": 2,
        "PU_Zone": "Newark Airport", "PU_Borough": "EWR",
        "DO_Zone": "Jamaica Bay", "DO_Borough": "Queens",
    }


def test_unknown_location_gives_null(trips, locations):
    row = with_location(trips, locations, "PULocationID").filter("PULocationID = 9").first()
    assert row["Zone"] is None


def test_top_k_is_not_a_full_sort(trips, locations):
    plan = top_locations(trips, locations, "PULocationID")._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()
