import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from cohortkit.operators import interpret as xp, ml, tree_scores


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), None if i % 31 == 0 else float(c), int(a + b * c > 0.3)) for i, (a, b, c) in enumerate(rng.normal(size=(700, 3)).round(2))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int").checkpoint()
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep"), ml.make_classifier("random_forest", numTrees=7, maxDepth=6)]
    return df, Pipeline(stages=stages).fit(df.na.drop())


def test_forest_variants_equal_the_models_own(spark, fitted, monkeypatch):
    df, model = fitted
    feats = ["a", "b", "c"]
    assert tree_scores.forest_of(model, 3, spark) is not None
    importance = xp.permutation_importance(model, df, feats, repeats=3)
    dependence = xp.partial_dependence(model, df, feats, resolution=12)
    fast = [r.asDict() for r in importance.orderBy("feature").collect()], [r.asDict() for r in dependence.orderBy("feature", "grid_value").collect()]
    monkeypatch.setattr(tree_scores, "forest_of", lambda *a: None)
    # By the model: each feature replaced on the row itself, no row copied per feature.
    slow = xp.permutation_importance(model, df, feats, repeats=3)
    assert slow._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    curves = xp.partial_dependence(model, df, feats, resolution=12)
    for got, want in zip(fast, ([r.asDict() for r in slow.orderBy("feature").collect()], [r.asDict() for r in curves.orderBy("feature", "grid_value").collect()])):
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g == {k: v if isinstance(v, str) else pytest.approx(v, abs=1e-12) for k, v in w.items()}


def test_grids_hold_few_values_or_quantiles(spark, monkeypatch):
    df = spark.range(300).selectExpr("cast(id % 3 as double) as x", "cast(id as double) as y")
    monkeypatch.setattr(DataFrame, "limit", lambda *a: pytest.fail("a limit brings the rows to one task"))
    grids = xp.pdp_grids(df, ["x", "y"], 5, 0.0, 1.0)
    assert grids == {"x": [0.0, 1.0, 2.0], "y": [0.0, 74.75, 149.5, 224.25, 299.0]}
