"""Keyed permutations, permutation importance, anchors of many instances and the weight-array bootstrap against plain versions."""

import hashlib
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.functions import keyed
from cohortkit.operators import interpret as xp
from cohortkit.operators.ml import LinearScorer
from cohortkit.operators.select import poisson1_cdf

FEATURES = ["a", "b", "c"]
SCORER = LinearScorer({"a": 2.0, "b": -1.0, "c": 0.1}, -0.3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(i, rng.gauss(0, 1), float(rng.randrange(4)), rng.random()) for i in range(150)]
    return [(*r, int(2 * r[1] - r[2] + rng.gauss(0, 1) > 0)) for r in out]


@pytest.fixture(scope="module")
def data(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int").repartition(5).cache()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 997])
def test_permutations_are_bijections_and_equal_in_spark(spark, n):
    lines = keyed.lines_of(7, 3)
    got = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "rep")).select("rep", "id", keyed.permuted_index(F.col("id"), n, F.col("rep"), lines).alias("to")).collect()
    for rep in range(3):
        keys = [of[rep] for of in lines]
        want = [keyed.permuted_number(i, n, keys) for i in range(n)]
        assert sorted(want) == list(range(n))
        assert {r["id"]: r["to"] for r in got if r["rep"] == rep} == dict(enumerate(want))
    if n > 900:  # no repeat is near the identity or to another
        moved = [[keyed.permuted_number(i, n, [of[rep] for of in lines]) for i in range(n)] for rep in range(3)]
        assert max(sum(x == y for x, y in zip(p, q)) for p in moved for q in [list(range(n)), *[m for m in moved if m is not p]]) < 12


def predicted(r):
    return int(-0.3 + 2.0 * r[1] - r[2] + 0.1 * r[3] > 0)


def test_permutation_importance_equals_brute_force(data, rows):
    got = {r["feature"]: (r["importance_mean"], r["importance_std"]) for r in xp.permutation_importance(SCORER, data, FEATURES, repeats=4, seed=3).collect()}
    base = statistics.mean(predicted(r) == r[4] for r in rows)
    lines = keyed.lines_of(3, 4)
    for j, f in enumerate(FEATURES, 1):
        drops = []
        for rep in range(4):
            to = [keyed.permuted_number(i, len(rows), [of[rep] for of in lines]) for i in range(len(rows))]
            drops.append(base - statistics.mean(predicted([rows[to[i]][c] if c == j else v for c, v in enumerate(r)]) == r[4] for i, r in enumerate(rows)))
        assert got[f] == (pytest.approx(statistics.mean(drops)), pytest.approx(statistics.pstdev(drops)))


def test_permutation_importance_cuts_ranges_once(data, capsys):
    """One numbering serves all features and repeats: nothing in the plan sorts or cuts rows again."""
    df = xp.permutation_importance(SCORER, data, FEATURES, repeats=4)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan
    assert plan.count("Join") == 1


def test_anchor_rules_equal_single_instances(spark, data, rows):
    got = {}
    for r in xp.anchor_rules(SCORER, data, data.where("id % 10 = 0"), FEATURES, max_rules=2).collect():
        got.setdefault(r["id"], []).append((r["step"], r["covered"], r["same"]))
        assert r["precision"] == pytest.approx(r["same"] / r["covered"]) and r["coverage"] == pytest.approx(r["covered"] / len(rows))
    assert sorted(got) == list(range(0, 150, 10))
    for i in (0, 50, 140):
        instance = dict(zip(["id", *FEATURES], rows[i][:4]))
        want = xp.anchors(SCORER, data, instance, FEATURES, max_rules=2).collect()
        assert [(s, pytest.approx(c / len(rows)), pytest.approx(k / c)) for s, c, k in sorted(got[i])] == [(w["step"], w["coverage"], w["precision"]) for w in want]


def test_anchor_rules_take_missing_values(spark, data):
    holes = data.withColumn("c", F.when(F.col("id") % 3 == 0, F.col("c")))
    scorer = LinearScorer({"a": 2.0, "b": -1.0}, 0.0)
    got = xp.anchor_rules(scorer, holes, holes.where("id < 4"), FEATURES, max_rules=3).collect()
    assert {r["id"] for r in got} == {0, 1, 2, 3}
    assert xp.anchor_rules(scorer, holes, holes.limit(0), FEATURES).count() == 0


def test_stability_equals_brute_force(spark):
    rng = random.Random(8)
    attr = [(i, f, rng.gauss(0, 1)) for i in range(120) for f in ("x", "y")] + [(500, "x", None)]
    df = spark.createDataFrame(attr, "id long, feature string, attribution double").repartition(6)
    got = {r["feature"]: r for r in xp.explanation_stability(df, ["id"], replicates=30, seed=5).collect()}
    cdf = poisson1_cdf(16)
    for f in ("x", "y"):
        means = []
        for rep in range(30):
            factor, addend = keyed.line(5, rep)
            top = below = 0.0
            for i, g, v in attr:
                if g == f and v is not None:
                    number = int(hashlib.md5(f"5|{i}".encode()).hexdigest()[:13], 16) % keyed.PRIME
                    w = sum(keyed.mix(number, factor, addend) / keyed.PRIME >= c for c in cdf)
                    top, below = top + w * abs(v), below + w
            means.append(top / below)
        assert got[f]["mean"] == pytest.approx(np.mean(means)) and got[f]["std"] == pytest.approx(np.std(means))
        assert [got[f]["p2_5"], got[f]["p97_5"]] == pytest.approx(list(np.percentile(means, [2.5, 97.5])))


def plain_lime(rows, chance, samples, seed, drawn, scale):
    out = {}
    for r in rows:
        Z = np.array([drawn[r[0], s] for s in range(samples)])
        y = np.array([chance([x + z * d for x, z, d in zip(r[1:4], zs, scale)]) for zs in Z])
        w = np.exp(-(Z ** 2).sum(1) / (0.75 * 3 ** 0.5) ** 2)
        X = np.hstack([np.ones((samples, 1)), Z])
        out[r[0]] = np.linalg.solve(X.T @ (X * w[:, None]) + np.diag([0.0, 1, 1, 1]), X.T @ (y * w))[1:]
    return out


def draws(spark, ids, samples, seed):
    df = spark.createDataFrame([(i, s) for i in ids for s in range(samples)], "id long, s int")
    u = lambda j: F.pmod(F.xxhash64(F.lit(seed), F.lit(j), F.col("s"), F.col("id")), F.lit(1 << 40)).cast("double")
    z = [F.when(F.col("s") == 0, 0.0).otherwise(F.sqrt(-2 * F.log((u(2 * j) + 1.0) / float((1 << 40) + 1))) * F.cos(2 * 3.141592653589793 * (u(2 * j + 1) / float(1 << 40)))) for j in range(3)]
    return {(r["id"], r["s"]): list(r["z"]) for r in df.select("id", "s", F.array(*z).alias("z")).collect()}


@pytest.mark.parametrize("kind", ["linear", "forest"])
def test_lime_equals_plain_fits_and_shuffles_no_perturbation(spark, data, rows, kind):
    if kind == "linear":
        model = SCORER
        chance = lambda x: 1 / (1 + np.exp(0.3 - 2.0 * x[0] + x[1] - 0.1 * x[2]))
    else:
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.linalg import Vectors
        model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"), RandomForestClassifier(numTrees=4, maxDepth=3, seed=1)]).fit(data)
        chance = lambda x: model.stages[-1].predictProbability(Vectors.dense(x))[1]
    df = xp.lime_weights(model, data, data.where("id < 4"), FEATURES, samples=40, seed=3)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and plan.index("Aggregate") < plan.index("MapInArrow", plan.index("Aggregate")) < plan.index("Generate")
    got = {}
    for r in df.collect():
        got.setdefault(r["id"], {})[r["feature"]] = r["weight"]
    want = plain_lime(rows[:4], chance, 40, 3, draws(spark, range(4), 40, 3), [statistics.pstdev(r[c] for r in rows) for c in (1, 2, 3)])
    assert {i: [w[f] for f in FEATURES] for i, w in got.items()} == {i: pytest.approx(list(w), rel=1e-7, abs=1e-9) for i, w in want.items()}


def test_anchor_rules_walk_once_a_kind(spark, data):
    """Instances of equal bins and prediction take one walk's steps; rows of one key share a walk and count each."""
    twins = data.where("id < 20").withColumn("id", F.col("id") + 1000)
    df = xp.anchor_rules(SCORER, data, data.where("id < 20").unionByName(twins), FEATURES)
    assert "FlatMapGroups" not in df._jdf.queryExecution().optimizedPlan().toString()
    steps = {}
    for r in df.collect():
        steps.setdefault(r["id"], []).append(tuple(r[c] for c in ("step", "rule", "covered", "same", "precision")))
    assert len(steps) == 40 and all(sorted(steps[i]) == sorted(steps[i + 1000]) for i in range(20))
    twice = {(r["id"], r["step"]): (r["covered"], r["precision"]) for r in xp.anchor_rules(SCORER, data, data.where("id < 20").unionByName(data.where("id < 20")), FEATURES).collect()}
    assert twice == {(i, s[0]): (2 * s[2], s[4]) for i in range(20) for s in steps[i]}
