import itertools

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from cohortkit.functions.distributions import chi2_sf, t_two_sided_p
from cohortkit.operators import evaluate as ev, stats


def test_tail_probabilities_known_values():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.0733880347707, rel=1e-9)
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(10.0, 4) == pytest.approx(0.0404276819945, rel=1e-9)


def test_welch_matches_formula(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 4.0, 6.0, 9.0]
    df = spark.createDataFrame([(x, 1) for x in a] + [(x, 0) for x in b], "x double, t int")
    r = stats.welch_tests(df, "t", ["x"]).first()
    v1, v0 = np.var(a, ddof=1), np.var(b, ddof=1)
    t = (np.mean(a) - np.mean(b)) / np.sqrt(v1 / 5 + v0 / 4)
    assert r["t_stat"] == pytest.approx(t)
    assert r["cohens_d"] == pytest.approx((np.mean(a) - np.mean(b)) / np.sqrt((v1 + v0) / 2))
    assert 0 < r["p_value"] < 1


def test_chi2_yates_2x2_and_symmetry(spark):
    # table [[10, 20], [30, 5]]: Yates chi2 from the textbook formula
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 5
    df = spark.createDataFrame(rows, "c string, t int")
    r = stats.chi2_tests(df, "t", ["c"]).first()
    obs = np.array([[10, 20], [30, 5]], float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi = (((np.abs(obs - e) - 0.5) ** 2) / e).sum()
    assert r["chi2"] == pytest.approx(chi)
    assert r["dof"] == 1
    assert r["cramers_v"] == pytest.approx(np.sqrt(chi / 65))
    flipped = spark.createDataFrame([(("b" if c == "a" else "a"), t) for c, t in rows], "c string, t int")
    assert stats.chi2_tests(flipped, "t", ["c"]).first()["chi2"] == pytest.approx(chi)


def test_chi2_empty_cell(spark):
    rows = [("a", 0)] * 5 + [("b", 1)] * 5 + [("c", 0)] * 3 + [("c", 1)] * 2
    r = stats.chi2_tests(spark.createDataFrame(rows, "c string, t int"), "t", ["c"]).first()
    obs = np.array([[5, 0], [0, 5], [3, 2]], float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert r["chi2"] == pytest.approx(((obs - e) ** 2 / e).sum())
    assert r["dof"] == 2


def test_corr_matrix_and_spearman(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200)})
    pdf["c"] = pdf["a"] * 2 + pdf["b"] ** 3
    df = spark.createDataFrame(pdf)
    m = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] == pytest.approx(pdf.corr().loc["a", "c"])
    s = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df, ["a", "b", "c"], "spearman").collect()}
    assert s[("b", "c")] == pytest.approx(pdf.corr("spearman").loc["b", "c"])
    assert m[("a", "a")] == 1.0


def test_constant_column_correlation_is_null_not_an_error(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 5.0, 0), (3.0, 5.0, 1)], "a double, c double, t int")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df, ["a", "c"]).collect()}
    assert m[("a", "c")] is None
    w = stats.welch_tests(spark.createDataFrame([(5.0, 1), (5.0, 0)], "c double, t int"), "t", ["c"]).first()
    assert w["t_stat"] is None


def test_mutual_information_determined_target(spark):
    rows = [(float(i % 10), i % 2) for i in range(1000)]
    r = stats.mutual_information(spark.createDataFrame(rows, "x double, t int"), "t", ["x"]).first()
    assert r["mutual_info"] == pytest.approx(np.log(2), rel=1e-6)  # x determines t


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=2, max_size=40))
def test_auc_equals_pair_count(spark, pairs):
    labels = [p[0] for p in pairs]
    if len(set(labels)) < 2:
        return
    df = spark.createDataFrame([(y, s / 5.0, int(s >= 3)) for y, s in pairs], "label int, score double, prediction int")
    auc = ev.roc_auc(df).first()["roc_auc"]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    exp = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert auc == pytest.approx(exp)


def test_pr_auc_and_curves(spark):
    ys = [1, 0, 1, 1, 0, 0, 1]
    ss = [0.9, 0.8, 0.7, 0.7, 0.4, 0.2, 0.1]
    df = spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in zip(ys, ss)], "label int, score double, prediction int")
    # hand-computed sklearn-style curve: thresholds .9,.8,.7,.4,.2,.1
    pts = [(0, 1.0), (0.25, 1.0), (0.25, 0.5), (0.75, 0.75), (0.75, 0.6), (0.75, 0.5), (1.0, 4 / 7)]
    area = sum((r2 - r1) * (p1 + p2) / 2 for (r1, p1), (r2, p2) in zip(pts, pts[1:]))
    assert ev.pr_auc(df).first()["pr_auc"] == pytest.approx(area)
    assert ev.pr_curve(df).count() == 6
    roc = ev.roc_curve(df).collect()
    assert len(roc) == 7 and max(r["tpr"] for r in roc) == 1.0


def test_metrics_and_calibration(spark):
    rows = [(1, 1, 0.95), (1, 0, 0.3), (0, 0, 0.1), (0, 1, 0.6), (1, 1, 0.8)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double")
    m = ev.classification_metrics(df).first()
    assert m["accuracy"] == pytest.approx(0.6) and m["precision"] == pytest.approx(2 / 3)
    assert m["recall"] == pytest.approx(2 / 3) and m["f1"] == pytest.approx(2 / 3)
    cal = {r["bin"]: r for r in ev.calibration_curve(df).collect()}
    assert set(cal) == {9, 2, 0, 5, 7}
    c = ev.confusion(df).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (1, 1, 1, 2)


def test_box_outliers_and_dedup_report(spark):
    from cohortkit.operators import select as sel
    rows = [(float(x), 0) for x in [1, 2, 3, 4, 100]] + [(float(x), 1) for x in [10, 11, 12, 13, -50]]
    df = spark.createDataFrame(rows, "x double, t int")
    out = sorted((r["t"], r["value"]) for r in stats.box_outliers(df, ["x"], "t").collect())
    assert out == [(0, 100.0), (1, -50.0)]
    b = stats.box_stats(df, ["x"], "t").where("t = 0").first()
    assert b["n_outliers"] == 1 and b["whisker_hi"] == 4.0
    rep = sel.dedup_report(df.unionByName(df.limit(3))).first()
    assert (rep["rows_before"], rep["rows_after"], rep["removed"]) == (13, 10, 3)


def test_spearman_ranks_over_common_rows(spark):
    import random

    import pandas as pd
    rng = random.Random(5)
    hole = lambda v, p: None if rng.random() < p else v
    rows = [(hole(float(rng.randrange(6)), 0.3), hole(rng.gauss(0, 1), 0.2), rng.gauss(0, 1), hole(float(i % 3), 0.9)) for i in range(200)]
    df = spark.createDataFrame(rows + [(float("nan"), 1.0, 0.5, 1.0)], "a double, b double, c double, d double").repartition(5)
    want = pd.DataFrame(rows + [(None, 1.0, 0.5, 1.0)], columns=list("abcd"), dtype=float)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df, list("abcd"), "spearman").collect()}
    for a in "abcd":
        for b in "abcd":
            both = want[[a, b]].dropna() if a != b else want[[a]].dropna()
            assert got[a, b] == pytest.approx(both[a].rank().corr(both[b].rank()))


def test_digest_is_made_below_the_explode(spark):
    from cohortkit.operators import features as fe
    df = spark.createDataFrame([("a bb ccc bb",)], "text string")
    plan = fe.term_counts(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("sha2(")  # the plan prints from the top down
