"""Stage outputs: whole or absent, and not made twice."""

import pytest
from pyspark.sql import functions as F

from triploom import ForestModel, read_stage, write_stage
from triploom.plans import pipeline
from triploom.plans.pipeline import PipelineParams, run_pipeline
from triploom.schema import TRIPS_SCHEMA
from triploom.sources import is_current, stage_digest
from triploom.sources.stages import KEPT_VERSIONS


def test_a_failed_write_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "stage")
    write_stage(spark.range(5), path, "one")
    broken = spark.range(9).withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        write_stage(broken, path, "two")
    assert read_stage(spark, path).count() == 5
    assert is_current(spark, path, "one") and not is_current(spark, path, "two")
    write_stage(spark.range(6), path, "two")
    assert read_stage(spark, path).count() == 6 and is_current(spark, path, "two")


def test_old_versions_go(spark, tmp_path):
    path = tmp_path / "stage"
    for n in range(1, 6):
        write_stage(spark.range(n), str(path))
        assert read_stage(spark, str(path)).count() == n
    whole = [p for p in path.glob("data-*") if (p / "_SUCCESS").exists()]
    assert len(whole) == KEPT_VERSIONS


def test_folders_without_a_manifest_are_read(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(4).write.parquet(path)
    assert read_stage(spark, path).count() == 4
    one = stage_digest(spark, path)
    assert one == stage_digest(spark, path)
    spark.range(4).write.mode("append").parquet(path)
    assert one != stage_digest(spark, path)
    assert not is_current(spark, str(tmp_path / "none"), "x")


@pytest.fixture
def params(tmp_path):
    rows = [",".join(TRIPS_SCHEMA.names)]
    for i in range(60):
        seconds = f"{i // 6:02d}:{i % 60:02d}"
        rows.append(f"1,2019-09-01 00:00:00,2019-09-01 00:{seconds},1,{1 + i % 5},1,N,{i % 3},{i % 4},1,9,0,0,0,0,0,{i}.5,0")
    (tmp_path / "trips.csv").write_text("\n".join(rows))
    return PipelineParams(str(tmp_path / "trips.csv"), str(tmp_path / "out"), num_trees=4, max_samples=16, contamination=0.05)


def test_a_rerun_goes_on_where_the_last_whole_stage_ended(spark, params, monkeypatch, tmp_path):
    made = []
    write = pipeline.write_stage
    monkeypatch.setattr(pipeline, "write_stage", lambda df, path, digest: made.append(path) or write(df, path, digest))
    fits = []
    fit = pipeline.fit_isolation_forest
    monkeypatch.setattr(pipeline, "fit_isolation_forest", lambda *a, **k: fits.append(1) or fit(*a, **k))

    def dies(df):
        raise RuntimeError("killed")

    clean = pipeline.drop_outliers
    monkeypatch.setattr(pipeline, "drop_outliers", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_pipeline(spark, params)
    assert made == [params.enriched_path, params.predicted_path] and fits == [1]
    monkeypatch.setattr(pipeline, "drop_outliers", clean)
    results = run_pipeline(spark, params)
    assert made[2:] == [params.cleaned_path] and fits == [1]
    first = {k: sorted(map(tuple, results[k].collect()), key=repr) for k in ("clean", "top_pairs")}
    run_pipeline(spark, params)
    assert len(made) == 3
    again = run_pipeline(spark, params, resume=False)
    assert len(made) == 6 and fits == [1, 1]
    assert {k: sorted(map(tuple, again[k].collect()), key=repr) for k in first} == first
    (tmp_path / "trips.csv").write_text((tmp_path / "trips.csv").read_text() + "\n" + "1,2019-09-01 00:00:00,2019-09-01 00:09:00,1,2,1,N,0,0,1,9,0,0,0,0,0,1,0")
    assert run_pipeline(spark, params)["prepare"].count() == again["prepare"].count() + 1
    assert len(made) == 9


def test_a_forest_is_saved_as_one(spark, params):
    run_pipeline(spark, params, ["prepare", "train"])
    model = ForestModel.load(spark, params.model_path)
    assert model.nodes["tree"].nunique() == 4 and model.contamination == 0.05 and model.threshold > 0
