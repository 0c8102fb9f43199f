import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import lab


@pytest.fixture(scope="module")
def lab_small(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 50809, t0, 80.0, 70.0, 100.0), (1, 50809, t0 + dt.timedelta(hours=1), 120.0, 70.0, 100.0),
            (1, 50809, t0 + dt.timedelta(hours=2), None, 70.0, 100.0), (2, 50810, t0, 1.0, 0.6, 1.2),
            (3, 99999, t0, 5.0, None, None)]
    return spark.createDataFrame(rows, "hadm_id long, itemid long, t timestamp, lab_x double, lab_x_lower double, "
                                       "lab_x_upper double")


def test_group_stats_single_row_std_null(lab_small):
    g = {r["hadm_id"]: r for r in lab.group_stats(lab_small, "hadm_id", ["lab_x"]).collect()}
    assert g[2]["lab_x_std"] is None
    assert g[1]["lab_x_mean"] == pytest.approx(100.0)
    assert g[1]["lab_x_median"] == pytest.approx(100.0)
    assert g[1]["lab_x_iqr"] == pytest.approx(20.0)
    assert g[1]["lab_x_range"] == pytest.approx(40.0)


def test_lab_features_trend_and_flags(lab_small):
    out = lab.lab_features(lab_small, "hadm_id", ["t", "itemid"]).orderBy("hadm_id", "t").collect()
    assert [r["lab_x_trend"] for r in out][:3] == [None, 40.0, None]
    assert [r["lab_x_trend_sign"] for r in out][:2] == [None, 1.0]
    assert [r["lab_x_is_abnormal"] for r in out] == [0, 1, 0, 0, 0]


def test_flag_abnormal_reference_table(spark, lab_small):
    out = lab.flag_abnormal(lab_small, "itemid", "lab_x", lab.lab_reference(spark)).orderBy("hadm_id", "t").collect()
    assert [r["is_abnormal"] for r in out] == [False, True, False, False, None]


@pytest.mark.parametrize("hot_rows", [1_000_000, 300])
def test_trend_hot_and_normal_paths_agree_with_pandas(spark, hot_rows):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"k": rng.integers(0, 4, n), "o": rng.permutation(n), "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    got = lab.trend(df, "k", ["o"], ["v"], hot_rows=hot_rows, num_partitions=8).toPandas().sort_values(["k", "o"])
    exp = pdf.sort_values(["k", "o"]).groupby("k")["v"].diff()
    assert np.allclose(got["v_trend"].fillna(-9).values, exp.fillna(-9).values)


def test_group_stats_hot_key_path(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 2000), "v": rng.normal(size=2000)})
    df = spark.createDataFrame(pdf)
    got = lab.group_stats(df, "k", ["v"], hot_rows=100).toPandas().set_index("k").sort_index()
    exp = pdf.groupby("k")["v"]
    assert np.allclose(got["v_median"], exp.median())
    assert np.allclose(got["v_iqr"], exp.quantile(0.75) - exp.quantile(0.25))
    assert np.allclose(got["v_std"], exp.std())


@pytest.mark.parametrize("hot_rows", [1_000_000, 200])
def test_key_features_paths_agree(spark, hot_rows):
    rng = np.random.default_rng(11)
    n = 2000
    pdf = pd.DataFrame({"k": rng.integers(0, 5, n), "o": rng.permutation(n), "v": rng.normal(size=n).round(3)})
    df = spark.createDataFrame(pdf)
    got = lab.key_features(df, "k", ["o"], ["v"], hot_rows=hot_rows).toPandas().sort_values(["k", "o"])
    p = pdf.sort_values(["k", "o"])
    g = p.groupby("k")["v"]
    assert np.allclose(got["v_trend"].fillna(-9).values, g.diff().fillna(-9).values)
    assert np.allclose(got["v_median"].values, g.transform("median").values)
    assert np.allclose(got["v_iqr"].values, (g.transform(lambda x: x.quantile(0.75) - x.quantile(0.25))).values)
    assert np.allclose(got["v_std"].values, g.transform("std").values)


@pytest.mark.parametrize("hot_rows", [1_000_000, 100])
def test_null_and_hot_keys(spark, hot_rows):
    """A third of the keys NULL, one key hot: NULL keys have no group, no trend and no statistics."""
    rng = np.random.default_rng(2)
    n = 1500
    k = [None if i % 3 == 0 else 7 if i % 3 == 1 else int(rng.integers(0, 50)) for i in range(n)]
    v = rng.normal(size=n).round(3)
    df = spark.createDataFrame([(k[i], i, float(v[i])) for i in range(n)], "k int, o int, v double")
    pdf = pd.DataFrame({"k": k, "o": range(n), "v": v})
    stats = lab.group_stats(df, "k", ["v"], hot_rows=hot_rows).toPandas()
    assert stats["k"].notna().all() and len(stats) == pdf["k"].nunique()
    out = lab.key_features(df, "k", ["o"], ["v"], hot_rows=hot_rows).toPandas().sort_values("o")
    assert len(out) == n and out.loc[out["k"].isna(), ["v_trend", "v_mean", "v_median"]].isna().all().all()
    g = pdf.sort_values("o").groupby("k")["v"]
    assert np.allclose(out["v_trend"].fillna(-9).values, g.diff().fillna(-9).values)
    assert np.allclose(out["v_median"].fillna(-9).values, g.transform("median").fillna(-9).values)


def test_no_null_key_reaches_a_window(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (1, 2, 2.0)], "k int, o int, v double")
    plan = lab.trend(df, "k", ["o"], ["v"], hot=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(k" in plan[plan.index("Window"):]
