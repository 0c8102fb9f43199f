import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cohortkit.operators import clean, scale, select as sel


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (3, float("inf"), None), (4, None, "b"), (5, -float("inf"), "a"),
            (6, 3.0, None), (6, 3.0, None)]
    return spark.createDataFrame(rows, "id long, x double, c string")


def test_missing_counts_count_nan(dirty):
    m = {r["column"]: r for r in clean.missing_counts(dirty).collect()}
    assert m["x"]["missing_count"] == 2
    assert m["c"]["missing_count"] == 3
    assert m["x"]["missing_percentage"] == pytest.approx(200 / 7)


def test_mode_ties_take_smallest(dirty):
    assert clean.mode_values(dirty, ["c"]) == {"c": "a"}


def test_clean_data(dirty):
    out = clean.clean_data(dirty, keys=["id"]).orderBy("id").collect()
    assert len(out) == 6                      # one duplicate removed
    xs = [r["x"] for r in out]
    assert xs == [1.0, 2.0, 2.0, 2.0, 2.0, 3.0]   # inf/NaN/null → median of {1, 3}
    assert [r["c"] for r in out] == ["a", "b", "a", "b", "a", "a"]


def test_handle_missing_constant(dirty):
    out = clean.handle_missing(dirty, "constant", fill_value=-1.0).orderBy("id").collect()
    assert out[3]["x"] == -1.0 and out[2]["c"] == "UNKNOWN"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=2, max_size=30))
def test_standard_scale_mean0_std1(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    z = [r[0] for r in scale.standard_scale(df, ["x"]).collect()]
    if np.std(xs) < 1e-9 * max(1.0, max(abs(x) for x in xs)):
        return
    assert np.mean(z) == pytest.approx(0, abs=1e-6)
    assert np.std(z) == pytest.approx(1, abs=1e-6)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert [r[0] for r in scale.standard_scale(df, ["x"]).collect()] == [0.0, 0.0, None]
    assert [r[0] for r in scale.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0, None]


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    out = scale.one_hot(df, ["c"]).collect()
    assert [r["c_a"] + r["c_b"] for r in out] == [1, 1, 1, 0]
    assert "c" not in out[0].asDict()


def test_robust_and_log(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    r = [row[0] for row in scale.robust_scale(df, ["x"]).collect()]
    assert r[2] == 0.0 and r[3] == pytest.approx(0.5)
    out, chosen = scale.log_transform_skewed(df, ["x"], 1.0)
    assert chosen == ["x"] and out.first()[0] == pytest.approx(math.log(2))


def test_iqr_filter_drops_outlier(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    assert sorted(r[0] for r in clean.iqr_filter(df, ["x"]).collect()) == [1, 2, 3, 4]


def test_inf_to_null_and_drop_any_null(dirty):
    out = sel.inf_to_null(dirty)
    assert out.where(F.col("x").isNull()).count() == 4
    assert sel.drop_any_null(dirty).count() == 2


def test_most_frequent_ties_are_numeric(spark):
    df = spark.createDataFrame([(9.0,), (9.0,), (10.0,), (10.0,), (None,)], "x double")
    assert clean.numeric_modes(df, ["x"]) == {"x": 9.0}
    out = [r[0] for r in clean.handle_missing(df, "most_frequent").collect()]
    assert out[-1] == 9.0


def test_one_hot_of_many_categories_is_a_sparse_vector(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "c string, v int")
    out = {r["v"]: list(r["c_ohe"].toArray()) for r in scale.one_hot(df, ["c"], max_categories=2).collect()}
    assert out == {1: [1, 0, 0], 2: [0, 1, 0], 3: [0, 0, 1], 4: [0, 0, 0]}


def test_tfidf_counts_every_row(spark):
    from cohortkit.operators import features as fe
    df = spark.createDataFrame([(1, "red red blue"), (1, "blue green"), (2, "blue green"), (3, None), (None, "red")], "k int, t string")
    out = fe.tfidf_features(df, "t", stop_words=[]).collect()
    assert len(out) == 5
    by = {(r["k"], r["t"]): [round(r[f"t_tfidf_{i}"], 6) for i in range(3)] for r in out}
    # Terms in order: blue and green in 3 and 2 of 5 rows, red in 2.
    import math
    idf = [math.log(6 / (1 + d)) + 1 for d in (3, 2, 2)]
    norm = math.hypot(idf[0], 2 * idf[2])
    assert by[(1, "red red blue")] == [round(idf[0] / norm, 6), 0.0, round(2 * idf[2] / norm, 6)]
    assert by[(1, "blue green")] == by[(2, "blue green")]
    assert by[(3, None)] == [0.0, 0.0, 0.0] and by[(None, "red")] == [0.0, 0.0, 1.0]


def test_only_columns_with_gaps_are_filled(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1.0, float("nan"), None, "a"), (2, 3.0, 5.0, None, "b"), (3, 2.0, 7.0, None, "b")],
                               "id int, x double, y double, z double, s string")
    assert clean.with_nulls(df, ["x", "y", "z", "s"]) == ["y", "z"]
    assert clean.with_nulls(df.limit(0), ["x", "s"]) == [] == clean.with_nulls(df, [])
    asked = []
    real = clean.median_values
    monkeypatch.setattr(clean, "median_values", lambda d, cols: asked.append(list(cols)) or real(d, cols))
    out = clean.handle_missing(df, "median", exclude=["id"]).orderBy("id").collect()
    assert asked == [["y", "z"]] and [r["y"] for r in out] == [6.0, 5.0, 7.0] and [r["z"] for r in out] == [None] * 3
