"""Hot keys by a sketch, the sequential sampler, and stacking without joins."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import lab, ml


def keys(n, seed):
    rng = random.Random(seed)
    return [(rng.choice([7, 7, 7, 8, None, rng.randrange(n)]), rng.choice(["a", "b"]), i) for i in range(n)]


@pytest.mark.parametrize("hot_rows", [1, 3, 50, 400, 10_000])
@pytest.mark.parametrize("tracked", [1_000_000, 60])
def test_hot_keys_equal_exact_counts(spark, monkeypatch, hot_rows, tracked):
    monkeypatch.setattr(lab, "MOST_TRACKED", tracked)  # 60: a sketch too coarse for the small bounds
    rows = keys(3000, hot_rows)
    df = spark.createDataFrame(rows, "k long, s string, v long").repartition(7)
    got = lab.find_hot_keys(df, ["k", "s"], hot_rows)
    want = {k: n for k, n in Counter(r[:2] for r in rows if r[0] is not None).items() if n > hot_rows}
    assert ({} if got is None else {(r["k"], r["s"]): r["_ck_n"] for r in got.collect()}) == want
    assert lab.find_hot_keys(df.limit(0), ["k"], hot_rows) is None


def test_the_sketch_shuffles_no_keys(spark):
    df = spark.createDataFrame(keys(3000, 1), "k long, s string, v long").repartition(7)
    plan = lab.key_sketch(df, ["k", "s"], 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k" in plan and "hashpartitioning" not in plan


SPACE = {"x": (0.0, 1.0, "float"), "y": (1e-4, 1.0, "log"), "k": (1, 20, "int")}


def surface(p):
    import math
    return -(p["x"] - 0.3) ** 2 - (math.log10(p["y"]) + 2) ** 2 / 4 - ((p["k"] - 12) / 20) ** 2


def searched(seed, n, startup):
    sampler = ml.TrialSampler(SPACE, seed, startup)
    for _ in range(n):
        places, values = sampler.ask()
        sampler.tell(places, surface(values))
    return sampler.history


def test_sequential_sampler_is_reproducible_and_within_ranges():
    assert searched(3, 30, 5) == searched(3, 30, 5) != searched(4, 30, 5)
    sampler = ml.TrialSampler(SPACE, 1)
    for i in range(40):
        places, p = sampler.ask()
        assert 0 <= p["x"] <= 1 and 1e-4 <= p["y"] <= 1 and 1 <= p["k"] <= 20 and isinstance(p["k"], int)
        sampler.tell(places, surface(p))


def test_sequential_sampler_beats_random_search():
    best = lambda startup: [max(s for _, s in searched(seed, 40, startup)) for seed in range(20)]
    guided, blind = best(5), best(40)
    assert sum(guided) > sum(blind) and sum(g >= b for g, b in zip(guided, blind)) >= 13


def test_sequential_tuning_and_stacking(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(i % 2, 1), rng.gauss(0, 1), i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, x double, y double, label int")
    best, scores = ml.tune(ml.assemble(df, ["x", "y"]), "logistic", n_trials=6, folds=2, sampler="sequential")
    assert len(scores) == 6 and max(scores) > 0.6 and best is not None
    assert scores == ml.tune(ml.assemble(df, ["x", "y"]), "logistic", n_trials=6, folds=2, sampler="sequential")[1]
    bases, meta, oof = ml.stacking(df, ["x", "y"], bases=("logistic", "random_forest"), folds=3)
    assert oof.columns == ["id", "label", "s_logistic", "s_random_forest"] and oof.count() == 240 == oof.select("id").distinct().count()
    assert "Join" not in oof._jdf.queryExecution().optimizedPlan().toString()
    # Each row is scored by the model of the other folds.
    from cohortkit.operators.select import stratified_folds
    folds = ml.assemble(stratified_folds(df, "label", ["id"], 3, 42, name="f"), ["x", "y"])
    model = ml.make_classifier("logistic").fit(folds.where("f <> 1"))
    from pyspark.ml.functions import vector_to_array
    want = {r["id"]: r["s"] for r in model.transform(folds.where("f = 1")).select("id", vector_to_array("probability")[1].alias("s")).collect()}
    got = {r["id"]: r["s_logistic"] for r in oof.collect()}
    assert all(got[i] == pytest.approx(s, abs=1e-9) for i, s in want.items())
