import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from cohortkit.functions.ordered import average_rank, prefix_sums, quantile_values, quantiles, row_index


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "x": rng.normal(size=3000).round(2),
                        "y": rng.exponential(size=3000)})
    pdf.loc[::17, "y"] = np.nan
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("max_candidates", [1_000_000, 50])
def test_quantiles_match_numpy(values, max_candidates):
    pdf, df = values
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantile_values(df, ["x", "y"], probs, max_candidates=max_candidates)
    for c in ["x", "y"]:
        exp = np.nanquantile(pdf[c], list(probs.values()))
        assert np.allclose([got[c][k] for k in probs], exp, rtol=0, atol=1e-12)


@pytest.mark.parametrize("max_candidates", [1_000_000, 40])
def test_grouped_quantiles(values, max_candidates):
    pdf, df = values
    q = quantiles(df, ["x"], {"m": 0.5, "q": 0.75}, by=["g"], max_candidates=max_candidates).toPandas()
    q = q.set_index("g").sort_index()
    exp = pdf.groupby("g")["x"].quantile([0.5, 0.75]).unstack()
    assert np.allclose(q[["m", "q"]].values, exp.values)


def test_row_index_is_a_permutation_in_order(spark):
    df = spark.range(5000).selectExpr("id", "cast(id % 7 as int) as k", "cast((id * 7919) % 5000 as long) as o")
    r = row_index(df, ["o", "id"], by=["k"], name="i").toPandas()
    for _, g in r.groupby("k"):
        g = g.sort_values(["o", "id"])
        assert list(g["i"]) == list(range(len(g)))


def test_prefix_sums_descending_inclusive(spark):
    pdf = pd.DataFrame({"s": [0.9, 0.8, 0.8, 0.1, 0.5], "w": [1, 2, 3, 4, 5]})
    df = spark.createDataFrame(pdf).groupBy("s").sum("w").withColumnRenamed("sum(w)", "w")
    out = prefix_sums(df, ["s"], {"c": df["w"]}, inclusive=True, descending=True).toPandas().sort_values("s")
    assert list(out["c"]) == [15, 11, 6, 1]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5), min_size=1, max_size=40))
def test_average_rank_matches_pandas(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = {r["v"]: r["rank"] for r in average_rank(df, "v").collect()}
    exp = pd.Series(xs, dtype=float).rank()
    for x, r in zip(xs, exp):
        assert got[float(x)] == pytest.approx(r)


def test_null_groups_nan_and_shared_prefixes(spark):
    nan = float("nan")
    rows = [(i, None if i % 4 == 0 else "g", [0.1, nan, 0.5, None][i % 4], f"Customer#{i:09d}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, v double, name string")
    r = row_index(df, ["name"], by=["g"], name="i", num_partitions=8).toPandas()
    assert len(r) == 400
    for _, part in r.groupby("g", dropna=False):
        assert list(part.sort_values("name")["i"]) == list(range(len(part)))
    order = [x["id"] % 4 for x in row_index(df, ["v", "id"], name="i", num_partitions=8).orderBy("i").collect()]
    assert order == [3] * 100 + [0] * 100 + [2] * 100 + [1] * 100  # nulls, numbers, NaN
    down = [x["id"] % 4 for x in prefix_sums(df, ["v", "id"], descending=True, num_partitions=8).orderBy("_ck_idx").collect()]
    assert down == order[::-1]


def test_largest_range_shrinks_with_more_ranges(spark):
    from cohortkit.functions.ordered import cut_by_range
    df = spark.range(200_000).selectExpr("concat('Customer#', lpad(cast(id as string), 12, '0')) as name")
    largest = [cut_by_range(df, ["name"], n).groupBy("_ck_pid").count().agg({"count": "max"}).first()[0] for n in (10, 100, 1000)]
    assert largest[0] < 40_000 and largest[1] < 5_000 and largest[2] < 1_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_gets_all_rows_of_a_column_or_group(spark, monkeypatch):
    from pyspark.sql import DataFrame
    df = spark.range(3000).selectExpr("cast(id as double) as x", "cast(id % 2 as string) as g")
    monkeypatch.setattr(DataFrame, "limit", lambda *a: pytest.fail("a limit brings the rows to one task"))
    assert quantile_values(df, ["x"], {"m": 0.5}, max_candidates=50) == {"x": {"m": 1499.5}}
    # Hot groups meet their bounds by broadcast, not by key.
    from cohortkit.functions import ordered
    met = []
    join = ordered._targets_join
    monkeypatch.setattr(ordered, "_targets_join", lambda *a: met.append(join(*a)) or met[-1])
    got = {r["g"]: r["m"] for r in quantiles(df, ["x"], {"m": 0.5}, by=["g"], max_candidates=50).collect()}
    assert got == {"0": 1499.0, "1": 1500.0}
    assert met and all("BroadcastHashJoin" in _plan(m) and "SortMergeJoin" not in _plan(m) for m in met)


def test_row_index_deals_rows_once(spark):
    df = spark.range(3000).selectExpr("id % 3 as g", "id as v")
    out = row_index(df, ["v"], by=["g"], name="i", num_partitions=4)
    assert "Window [" not in _plan(out).split("_ck_range")[0] and "hashpartitioning(g" not in _plan(out)
    assert out.where("v <> i * 3 + g").count() == 0
