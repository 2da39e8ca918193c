"""Every registered query with SQL, against DuckDB on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from triploom.plans.oracles import ORACLES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = queries()[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    theirs = duck.execute(oracle_sql()[name])
    names = [c[0] for c in theirs.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in theirs.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    assert got == expected
    assert got


def test_every_sql_has_a_query():
    assert oracle_sql().keys() <= queries().keys()


def test_flagship(spark):
    assert entry(spark).count() == 10


def test_forest_queries_find_few_outliers(spark):
    rows = queries()["outliers_iforest"](spark, SF_DIR).collect()
    assert rows
    assert all(r["predictedLabel"] == 1.0 and 0 < r["outlierScore"] < 1 for r in rows)
