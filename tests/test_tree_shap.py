"""Shapley values of trees against the definition, and their sums against the models."""

import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortkit.operators import tree_shap as ts

FEATURES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1) if j % 2 else float(rng.randrange(5)) for j in range(6)]
        rows.append((i, *x, int(x[0] + x[1] * x[3] - x[4] + rng.gauss(0, 0.5) > 1)))
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int").cache()


def fitted(data, name):
    made = {"tree": DecisionTreeClassifier(maxDepth=4, seed=1), "forest": RandomForestClassifier(numTrees=4, maxDepth=5, seed=1, subsamplingRate=0.7),
            "boosted": GBTClassifier(maxIter=4, maxDepth=3, seed=1)}[name]
    return made.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data))


def by_definition(trees, weights, boosted, x):
    """Every subset enumerated; a tree's value given a subset follows x where the split is known and both children by their rows otherwise."""
    cover = (lambda n: n["impurityStats"][0]) if boosted else (lambda n: sum(n["impurityStats"]))

    def value(nodes, node, known):
        if node["leftChild"] < 0:
            return node["prediction"] if boosted else node["impurityStats"][1] / sum(node["impurityStats"])
        left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
        f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        if f in known:
            return value(nodes, left if x[f] <= cut else right, known)
        return sum(cover(c) / cover(node) * value(nodes, c, known) for c in (left, right))

    def total(known):
        return sum((weights[t] if boosted else 1 / len(trees)) * value(nodes, nodes[0], known) for t, nodes in trees.items())

    n, out = len(x), []
    for j in range(n):
        rest = [i for i in range(n) if i != j]
        out.append(sum(factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (total({*s, j}) - total(set(s)))
                       for size in range(n) for s in combinations(rest, size)))
    return out, total(set())


@pytest.mark.parametrize("name", ["tree", "forest", "boosted"])
def test_values_equal_subset_enumeration(spark, data, name):
    trees, weights, boosted = ts._nodes(fitted(data, name), spark)
    leaves = ts.leaves_of(trees, weights, boosted)
    x = np.array([[float("nan") if v is None else v for v in r] for r in data.select(*FEATURES).limit(12).collect()] + [[float("nan")] * 6])
    got = ts.shapley_values(x, leaves)
    for row, values in zip(x, got):
        want, base = by_definition(trees, weights, boosted, row)
        assert values == pytest.approx(want, abs=1e-12) and ts.base_value(leaves) == pytest.approx(base, abs=1e-12)


@pytest.mark.parametrize("name", ["tree", "forest", "boosted"])
def test_values_add_up_to_the_score(spark, data, name):
    model = fitted(data, name)
    long, base = ts.tree_attributions(model, data.withColumn("value", F.lit("clash")), FEATURES)
    assert long.columns == ["id", "feature", "value", "attribution"] and long.count() == 6 * data.count()
    score = "rawPrediction" if name == "boosted" else "probability"
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data)).select("id", vector_to_array(score)[1].alias("s"))
    gap = long.groupBy("id").agg((F.sum("attribution") + base).alias("t")).join(scored, "id").agg(F.max(F.abs(F.col("t") - F.col("s")))).first()[0]
    assert gap < 1e-9


def test_categories_and_empty_table(spark, data):
    indexed = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(data))
    model = DecisionTreeClassifier(maxDepth=5, seed=1).fit(indexed.transform(VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(data)))
    trees, weights, boosted = ts._nodes(model, spark)
    assert any(n["split"]["numCategories"] > 0 for n in trees[0].values())
    leaves = ts.leaves_of(trees, weights, boosted)
    scored = model.transform(indexed.transform(VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(data))).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("s")).collect()
    got = ts.shapley_values(np.array([r["x"] for r in scored]), leaves).sum(1) + ts.base_value(leaves)
    assert got == pytest.approx([r["s"] for r in scored], abs=1e-12)
    assert ts.tree_attributions(model, data.limit(0), FEATURES)[0].count() == 0
