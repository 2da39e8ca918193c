import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from triploom import ForestModel, fit_isolation_forest, outliers
from triploom.operators.iforest import average_path, forest_samples, grow_trees

PLANTED = [(2001, 60.0, -60.0), (2002, -75.0, 55.0), (2003, 90.0, 90.0)]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(2000, 2)))]
    return spark.createDataFrame(rows + PLANTED, "id long, a double, b double").persist()


def featured(df, *columns):
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def test_average_path():
    assert average_path(1) == 0.0
    assert average_path(2) == 1.0
    assert average_path(256) == pytest.approx(10.244, abs=1e-2)


@pytest.mark.parametrize("columns", [("a",), ("a", "b")])
def test_planted_outliers_are_found(points, columns):
    df = featured(points, *columns)
    model = fit_isolation_forest(df, "id", contamination=0.002)
    result = model.transform(df)
    low, high = result.agg(F.min("outlierScore"), F.max("outlierScore")).first()
    assert 0.0 < low < high < 1.0
    found = {r["id"] for r in outliers(result).collect()}
    assert found >= {p[0] for p in PLANTED}
    assert len(found) <= 2 * 0.002 * 2003 + 2


def test_layout_does_not_matter(points):
    df = featured(points, "a", "b")
    one = fit_isolation_forest(df.repartition(7), "id", num_trees=20, max_samples=64)
    two = fit_isolation_forest(df.coalesce(1), "id", num_trees=20, max_samples=64)
    assert one.nodes.equals(two.nodes)
    assert one.threshold == two.threshold
    other = fit_isolation_forest(df, "id", num_trees=20, max_samples=64, seed=2)
    assert not one.nodes.equals(other.nodes)


def test_trees_are_within_bounds(points):
    model = fit_isolation_forest(featured(points, "a"), "id", num_trees=10, max_samples=32)
    leaves = model.nodes[model.nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == 32).all()
    assert model.nodes["tree"].nunique() == 10
    assert model.nodes["depth"].max() <= 5


def test_one_feature_agrees_with_the_walk(points):
    """The merged step function of a one-feature forest scores like its trees."""
    df = featured(points, "a")
    model = fit_isolation_forest(df, "id", num_trees=15, max_samples=50)
    steps = {r["id"]: r["outlierScore"] for r in model.score(df).collect()}
    packed = model._packed()
    from triploom.operators.iforest import _walk

    for row in points.filter("id % 97 = 0").collect():
        assert steps[row["id"]] == pytest.approx(_walk(packed, np.array([[row["a"]]]))[0])


def test_one_feature_scores_without_python(points):
    df = featured(points, "a")
    model = fit_isolation_forest(df, "id", num_trees=10, max_samples=32)
    plan = model.transform(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_growing_shuffles_by_tree_alone(points):
    samples = forest_samples(featured(points, "a", "b"), "id", num_trees=10, max_samples=32)
    grown = grow_trees(samples, width=2, max_depth=5, seed=1)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the samples by tree
    assert "Python" not in plan and "Join" not in plan


def test_odd_values_score_by_the_outer_intervals(spark, points):
    model = fit_isolation_forest(featured(points, "a"), "id", num_trees=10, max_samples=32)
    odd = spark.createDataFrame([(1, [float("nan")]), (2, [None]), (3, [float("inf")]), (4, [1e300]), (5, [float("-inf")]), (6, [-1e300])], "id long, x array<double>")
    scores = {r["id"]: r["outlierScore"] for r in model.score_values(odd, "x").collect()}
    assert scores[1] == scores[3] == scores[4] and scores[5] == scores[6] and scores[2] is None


def test_save_and_load(spark, points, tmp_path):
    df = featured(points, "a", "b")
    model = fit_isolation_forest(df, "id", num_trees=10, max_samples=32)
    for _ in range(2):  # saving replaces
        model.save(spark, str(tmp_path / "model"))
    again = ForestModel.load(spark, str(tmp_path / "model"))
    one = {r["id"]: (r["outlierScore"], r["predictedLabel"]) for r in model.transform(df).collect()}
    two = {r["id"]: (r["outlierScore"], r["predictedLabel"]) for r in again.transform(df).collect()}
    assert one == two


def test_small_and_constant_tables(spark):
    df = featured(spark.createDataFrame([(i, 1.0) for i in range(5)], "id long, a double"), "a")
    model = fit_isolation_forest(df, "id", num_trees=5)
    assert model.sample_size == 5
    assert model.transform(df).select("outlierScore").distinct().count() == 1
    with pytest.raises(ValueError):
        fit_isolation_forest(df.limit(0), "id")
