import re
from datetime import datetime

import pytest

from triploom import read_edges, read_locations, read_trips, read_vertices, write_csv
from triploom.schema import LOCATIONS_SCHEMA, TRIPS_SCHEMA
from triploom.sources import cut_lineage, read_stage, write_stage
from triploom.sources.checkpoints import shared_base

HEADER = ",".join(TRIPS_SCHEMA.names)
LINES = [
    "1,2021-03-04 10:00:01,2021-03-04 10:00:09,2,.00,1,N,7,9,2,3.5,1,0.25,0,0,0.1,4.85,0",
    ",2021-03-04 11:30:00,2021-03-04 11:45:30,,6.1,,,12,8,,17.75,0,0.25,0,0,0.1,18.1,1.5",
]


@pytest.fixture
def trips_file(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join([HEADER, *LINES]).encode())
    return str(path)


def test_trips_csv_parses_each_text_once(spark, trips_file):
    plan = read_trips(spark, trips_file)._jdf.queryExecution().optimizedPlan().toString()
    for name in ("total_amount", "trip_distance", "tpep_pickup_datetime"):
        assert len(re.findall(rf"cast\({name}#", plan)) == 1, plan


def test_trips_csv_with_mark_and_windows_line_ends(spark, trips_file):
    df = read_trips(spark, trips_file)
    assert df.schema == TRIPS_SCHEMA
    first, second = df.collect()
    assert first["VendorID"] == 1
    assert first["trip_distance"] == 0.0
    assert first["congestion_surcharge"] == 0.0
    assert first["tpep_dropoff_datetime"] == datetime(2021, 3, 4, 10, 0, 9)
    assert [second[c] for c in ("VendorID", "passenger_count", "store_and_fwd_flag")] == [None] * 3


def test_columns_are_found_by_name(spark, tmp_path, trips_file):
    names = TRIPS_SCHEMA.names
    order = [*reversed(names)]
    rows = [dict(zip(names, line.split(","), strict=True)) for line in LINES]
    lines = [",".join(["note", *order]), *(",".join(["x", *(r[n] for n in order)]) for r in rows)]
    path = tmp_path / "reordered.csv"
    path.write_text("\n".join(lines))
    assert read_trips(spark, str(path)).collect() == read_trips(spark, trips_file).collect()


def test_missing_columns_and_malformed_values_fail(spark, tmp_path):
    path = tmp_path / "few.csv"
    path.write_text("VendorID,trip_distance\n1,2.0\n")
    with pytest.raises(ValueError, match="total_amount"):
        read_trips(spark, str(path))
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n7.0,A,B,C\n")
    assert read_locations(spark, str(zones)).first()["LocationID"] == 7
    zones = tmp_path / "bad.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n7.5,A,B,C\n")
    with pytest.raises(Exception, match="LocationID is not a int"):
        read_locations(spark, str(zones)).collect()


def test_inferred_schema_is_the_same(spark, trips_file):
    df = read_trips(spark, trips_file, infer=True)
    assert df.columns == TRIPS_SCHEMA.names
    assert dict(df.dtypes)["trip_distance"] == "double"
    assert dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp"


def test_locations_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
        '264,"Unknown","NV","N/A"\n265,"Unknown","NA","N/A"\n'
    )
    df = read_locations(spark, str(path))
    assert df.schema == LOCATIONS_SCHEMA
    assert [tuple(r) for r in df.filter("LocationID > 263").collect()] == [
        (264, "Unknown", "NV", "N/A"),
        (265, "Unknown", "NA", "N/A"),
    ]


def test_graph_files_by_position(spark, tmp_path):
    vertices = spark.createDataFrame([(0, 10.0), (1, 16.5)], "tripId long, trip_distance double")
    edges = spark.createDataFrame([(0, 1, 1)], "tripA long, tripB long, nb long")
    for name, df in (("vertices", vertices), ("edges", edges)):
        write_csv(df, str(tmp_path / name), single_file=True)
        assert len(list((tmp_path / name).glob("part-*.csv"))) == 1
    read = read_vertices(spark, str(tmp_path / "vertices"))
    assert read.dtypes == [("tripId", "bigint"), ("weight", "double")]
    assert {tuple(r) for r in read.collect()} == {(0, 10.0), (1, 16.5)}
    assert [tuple(r) for r in read_edges(spark, str(tmp_path / "edges")).collect()] == [(0, 1)]


def test_stage_output_is_replaced(spark, trips_file, tmp_path):
    path = str(tmp_path / "stage.parquet")
    trips = read_trips(spark, trips_file)
    write_stage(trips, path)
    write_stage(trips.limit(1), path)
    assert read_stage(spark, path).count() == 1
    assert read_trips(spark, path, fmt="parquet").columns == TRIPS_SCHEMA.names


def test_unknown_format(spark, trips_file):
    with pytest.raises(ValueError):
        read_trips(spark, trips_file, fmt="xml")


def test_checkpoints_cut_the_lineage(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x").filter("x > 4"))
    assert "Filter" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 7
    assert spark.sparkContext.getCheckpointDir() is not None


class FakeSession:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *other: settings.get(key.split(".")[1] if "checkpoint" in key else "warehouse", *other))})


def test_a_local_disk_is_no_shared_folder():
    assert shared_base(FakeSession("yarn", checkpoint="store://c/", warehouse="file:/w")) == "store://c"
    assert shared_base(FakeSession("local[4]", warehouse="file:/w/")) == "file:/w/checkpoints"
    assert shared_base(FakeSession("yarn", warehouse="store://w")) == "store://w/checkpoints"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_base(FakeSession("spark://host:7077", warehouse=warehouse))
