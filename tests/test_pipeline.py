import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from triploom import read_locations, read_trips, with_trip_id
from triploom.__main__ import main
from triploom.plans.pipeline import PipelineParams, run_pipeline
from triploom.plans.reports import chain_report, profile_report
from triploom.schema import TRIPS_SCHEMA


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("trips")
    rng = random.Random(11)
    lines = [",".join(TRIPS_SCHEMA.names)]
    for i in range(400):
        pickup = datetime(2019, 9, 1) + timedelta(seconds=rng.randrange(7200))
        seconds, miles = rng.randint(300, 1200), rng.uniform(1, 4)
        if i < 2:
            seconds, miles = 2, 90.0  # planted outliers
        dropoff = pickup + timedelta(seconds=seconds)
        places = f"{rng.randint(1, 9)},{rng.randint(1, 9)}"
        amounts = f"9.5,0.5,0.5,0,0,0.3,{rng.randint(5, 50)}.25,2.5"
        lines.append(f"1,{pickup},{dropoff},1,{miles:.2f},1,N,{places},1,{amounts}")
    (folder / "trips.csv").write_text("\n".join(lines))
    zones = [f'{i},"Borough {i}","Zone {i}","Boro Zone"' for i in range(1, 10)]
    (folder / "zones.csv").write_text(
        "\n".join(['"LocationID","Borough","Zone","service_zone"', *zones])
    )
    return folder


@pytest.fixture(scope="module")
def params(files):
    return PipelineParams(
        trips_path=str(files / "trips.csv"),
        base_dir=str(files / "stages"),
        num_trees=20,
        max_samples=64,
        contamination=0.005,
    )


def test_whole_pipeline(spark, params):
    results = run_pipeline(spark, params)
    found = results["predict"].collect()
    assert sorted(r["trip_distance"] for r in found)[-2:] == [90.0, 90.0]
    assert results["clean"].count() == results["prepare"].count() - len(found)
    amounts = [r["total_amount"] for r in results["top_pairs"].collect()]
    assert amounts == sorted(amounts, reverse=True)
    own = {(r[0], r[1]): r[2] for r in results["top_pairs"].collect()}
    around = {(r[0], r[1]): r[2] for r in results["top_neighbours"].collect()}
    assert own.keys() == around.keys()
    assert all(around[pair] >= own[pair] for pair in own)


def test_stages_run_alone(spark, params):
    run_pipeline(spark, params, ["prepare", "train", "predict", "clean"])
    top = run_pipeline(spark, params, ["top_pairs"])
    assert list(top) == ["top_pairs"]
    with pytest.raises(ValueError):
        run_pipeline(spark, params, ["deploy"])


def test_paths_carry_the_parameters(params):
    assert "enriched_speed-" in params.enriched_path
    others = [
        replace(params, features="speed_distance"), replace(params, features=("trip_distance",)), replace(params, seed=9),
        replace(params, num_trees=7), replace(params, max_samples=9), replace(params, contamination=0.1), replace(params, trips_path="other.csv"),
    ]
    for stage in ("model_path", "predicted_path", "cleaned_path"):
        assert len({getattr(p, stage) for p in [params, *others]}) == len(others) + 1


def test_reports(spark, files):
    trips = read_trips(spark, str(files / "trips.csv"))
    report = profile_report(trips, read_locations(spark, str(files / "zones.csv")))
    assert report["top_pickups"].count() == 9
    assert report["top_paths"].count() == 10
    assert report["pair_summary"].count() == 3
    chains = chain_report(with_trip_id(trips), weights=["count"])
    best = chains["chains_count"].first()["longestDistance"]
    path = chains["path_count"].first()["path"]
    assert path.count(" > ") == best - 1


def test_command_line(spark, files, capsys, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    trips, zones = str(files / "trips.csv"), str(files / "zones.csv")
    main(["profile", "--trips", trips, "--locations", zones])
    main(["outliers", "--trips", trips, "--base-dir", str(files / "cli"), "--key", "struct"])
    main(["chains", "--trips", trips, "--weights", "count"])
    shown = capsys.readouterr().out
    assert all(name in shown for name in ("top_paths", "top_neighbours", "path_count"))
