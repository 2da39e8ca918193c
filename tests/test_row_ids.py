"""Row ids that depend on the files alone."""

import pytest
from pyspark.sql import functions as F

from triploom import with_trip_id


@pytest.fixture
def layouts(spark):
    """Runs the test's reads with large splits and with many small ones."""
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in sizes}

    def set_layout(split, cost, least):
        for key, value in zip(sizes, (split, cost, least), strict=True):
            spark.conf.set(key, value)

    yield set_layout
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def ids(df):
    return {r["n"]: r["tripId"] for r in with_trip_id(df).select("n", "tripId").collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ids_follow_the_files(spark, tmp_path, layouts, fmt):
    path = str(tmp_path / "trips")
    rows = spark.range(4_000).select(F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("text"))
    rows.repartitionByRange(3, "n").sortWithinPartitions(F.desc("n")).write.option("header", True).format(fmt).save(path)

    def read():
        return spark.read.schema("n long, text string").option("header", True).format(fmt).load(path).select("n", F.upper("text"))

    layouts("128m", "4m", "1")
    one = ids(read())
    assert sorted(one.values()) == list(range(4_000))
    files = read().withColumn("f", F.input_file_name()).orderBy("f", F.desc("n"))
    assert [one[r["n"]] for r in files.collect()] == list(range(4_000))
    layouts("20k", "1", "16")
    assert read().rdd.getNumPartitions() >= 6
    assert ids(read()) == one
    if fmt == "parquet":
        assert ids(read().repartition(16)) == one
        some = ids(read().filter("n % 3 = 0"))
        assert len(set(some.values())) == len(some)


def test_other_tables_keep_sparks_numbers(spark):
    assert sorted(ids(spark.range(9).withColumnRenamed("id", "n").coalesce(1)).values()) == list(range(9))
    assert ids(spark.createDataFrame([], "n long")) == {}
