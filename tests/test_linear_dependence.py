import pytest
from pyspark.sql import functions as F

from cohortkit.operators import interpret as xp, ml


class Plain:
    """The same scorer as a model of no known kind."""
    def __init__(self, scorer):
        self.transform = scorer.transform


def _curves(model, df, feats):
    return {(r["feature"], r["grid_value"]): r["mean_prediction"] for r in xp.partial_dependence(model, df, feats, resolution=7).collect()}


def test_linear_scores_by_batch_equal_the_exploded_rows(spark):
    rows = [(i, i % 5 / 2.0, (i * 37 % 101) / 9.0, float(i % 3), 1000.0 if i % 50 == 1 else 0.5) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    for weights, feats in (({"a": 1.5, "b": -0.4, "d": -2.0}, ["a", "b", "c"]), ({"a": 1.0}, ["a", "d"]), ({}, ["c"])):
        scorer = ml.LinearScorer(weights, -0.3)
        got, want = _curves(scorer, df, feats), _curves(Plain(scorer), df, feats)
        assert set(got) == set(want) and len(got) > 2
        assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_linear_rows_without_a_score(spark):
    df = spark.createDataFrame([(1.0, 0.5), (2.0, None), (None, 2.5)], "a double, b double")
    scorer = ml.LinearScorer({"a": 1.0, "b": 1.0})
    # The row without b has no score when a is replaced; the one without a has.
    want = _curves(Plain(scorer), df.where("b is not null").fillna(1.0), ["a"])
    assert _curves(scorer, df, ["a"]) == {("a", 1.0): pytest.approx(want["a", 1.0]), ("a", 2.0): pytest.approx(_curves(Plain(scorer), df.where("b is not null").selectExpr("2D as a", "b"), ["a"])["a", 2.0])}
    assert _curves(scorer, df.selectExpr("a", "cast(null as double) as b"), ["a"]) == {("a", 1.0): None, ("a", 2.0): None}
    assert _curves(scorer, df.where(F.col("a") > 5), ["a"]) == {}


def test_linear_rows_are_not_copied_per_grid_value(spark):
    df = spark.range(50).selectExpr("cast(id as double) as a")
    plan = xp.partial_dependence(ml.LinearScorer({"a": 1.0}), df, ["a"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
