import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import interpret as xp, ml
from cohortkit.sources import sinks, tables


@pytest.fixture(scope="module")
def sep(spark):
    rng = np.random.default_rng(0)
    n = 600
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (x1 + 0.3 * rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, label int")


def test_csv_roundtrip_and_missing_file(spark):
    d = tempfile.mkdtemp(prefix="ck-src-")
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00", 2.5)], "subject_id long, ADMITTIME string, v double")
    sinks.write_table(df, f"{d}/t", "csv")
    back = tables.load_with_times(spark, f"{d}/t", ["ADMITTIME", "DISCHTIME"])
    assert dict(back.dtypes)["ADMITTIME"] == "timestamp_ntz"
    with pytest.raises(FileNotFoundError):
        tables.load_named(spark, {"x": f"{d}/nope.csv"})
    sinks.write_feature_list(spark, ["a", "b"], f"{d}/features")
    assert sinks.read_feature_list(spark, f"{d}/features") == ["a", "b"]
    sinks.write_metrics({"a": {"b": np.float64(1.5)}, "c": "x"}, f"{d}/m", spark)
    m = {r["metric"]: r for r in spark.read.json(f"{d}/m").collect()}
    assert m["a.b"]["value"] == 1.5 and m["c"]["text"] == "x"


def test_project_features(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, t int")
    assert tables.project_features(df, ["b", "zz"], "t").columns == ["b", "t"]
    assert tables.project_features(df, [], "t").columns == ["a", "b", "t"]


def test_train_model_separable(sep):
    model, scored, metrics = ml.train_model(sep, ["x1", "x2"], "logistic", "label", ["id"])
    m = metrics.first()
    assert m["roc_auc"] > 0.9 and m["accuracy"] > 0.8
    d = tempfile.mkdtemp(prefix="ck-model-")
    sinks.save_model(model, f"{d}/m")
    again = sinks.load_model(f"{d}/m")
    assert again.transform(sep).count() == 600


def test_pca_kmeans(sep):
    var, n95, proj = ml.pca_analysis(sep, ["x1", "x2"], key=["id"])
    rows = var.collect()
    assert rows[-1]["cumulative"] == pytest.approx(1.0) and n95 in (1, 2)
    assert proj.count() == 600
    summary, assigned, clusters = ml.kmeans_analysis(sep, ["x1", "x2"], k=3, seed=42)
    assert sum(summary["sizes"]) == 600


def test_smote_balances(sep):
    imb = sep.where((F.col("label") == 0) | (F.col("id") % 4 == 0))
    counts = {r[0]: r[1] for r in imb.groupBy("label").count().collect()}
    bal = ml.smote(imb, ["x1", "x2"], "label", ["id"], k=3, bucket_length=1.0, max_distance=2.0)
    after = {r[0]: r[1] for r in bal.groupBy("label").count().collect()}
    assert after[0] == counts[0] and counts[1] < after[1] <= counts[0]


def test_explanations(spark, sep):
    model, scored, metrics = ml.train_model(sep, ["x1", "x2"], "random_forest", "label", ["id"], numTrees=10)
    imp = xp.builtin_importances(model, ["x1", "x2"], spark).collect()
    assert imp[0]["feature"] == "x1"
    perm = xp.permutation_importance(model, sep, ["x1", "x2"], "label", ["id"], repeats=2).collect()
    assert perm[0]["feature"] == "x1" and perm[0]["importance_mean"] > 0.1
    pdp = xp.partial_dependence(model, sep, ["x1"], resolution=5).collect()
    assert len(pdp) == 5
    cmp_ = xp.compare_explanations(
        spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "feature string, importance double"),
        spark.createDataFrame([("a", 30.0), ("b", 20.0), ("c", 10.0)], "feature string, importance double")).first()
    assert cmp_["spearman"] == pytest.approx(1.0)


def test_lsh_buckets_are_bounded(spark):
    from pyspark.ml.functions import vector_to_array
    rows = [(i, float(i % 97) / 1000.0, float(i % 89) / 1000.0) for i in range(3000)]  # one dense blob
    df = ml.assemble(spark.createDataFrame(rows, "id long, a double, b double"), ["a", "b"], "v")
    model, b = ml.fit_lsh_bounded(df, "v", bucket_length=10.0, num_tables=2, seed=1, max_bucket=200)
    assert b < 10.0
    h = model.transform(df).select(F.posexplode("_ck_h").alias("t", "x"))
    biggest = h.groupBy("t", vector_to_array("x")[0].alias("k")).count().agg(F.max("count")).first()[0]
    assert biggest <= 200


@pytest.mark.parametrize("keep_every", [4, 2])
def test_smote_exact_size_small_and_large_deficit(sep, keep_every):
    imb = sep.where((F.col("label") == 0) | (F.col("id") % keep_every == 0))
    dup = imb.unionByName(imb.where(F.col("label") == 1).limit(5).withColumn("id", F.col("id") + 100000))
    counts_dup = {r[0]: r[1] for r in dup.groupBy("label").count().collect()}
    bal = ml.smote(dup, ["x1", "x2"], "label", ["id"], k=3, bucket_length=1.0, max_distance=3.0)
    after = {r[0]: r[1] for r in bal.groupBy("label").count().collect()}
    assert after[0] == counts_dup[0]
    assert after[1] == counts_dup[0]  # every minority row has a neighbour here: exact balance


def test_counterfactuals_are_the_nearest_rows_of_the_other_class(spark):
    import math
    import random

    from cohortkit.operators.interpret import counterfactuals

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", (F.col("x") > 0).cast("double"))

    rng = random.Random(4)
    rows = [(i, rng.uniform(-1, -0.5), rng.gauss(0, 5)) for i in range(400)] + [(400, 60.0, 40.0), (401, -70.0, 2.0), (402, 0.4, -60.0), (403, 0.4, -60.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    sd = [math.sqrt(sum((r[c] - sum(q[c] for q in rows) / len(rows)) ** 2 for r in rows) / len(rows)) for c in (1, 2)]
    dist = lambda a, b: math.sqrt(sum(((a[c + 1] - b[c + 1]) / sd[c]) ** 2 for c in (0, 1)))
    asked = [0, 7, 400, 401, 402]
    got = {r["id"]: (r["cf_id"], r["distance"]) for r in counterfactuals(Model(), df, df.where(F.col("id").isin(asked)), ["x", "y"]).collect()}
    assert sorted(got) == asked
    for i in asked:
        want = min((dist(rows[i], r), r[0]) for r in rows if (r[1] > 0) != (rows[i][1] > 0))
        assert abs(got[i][1] - want[0]) < 1e-9 and got[i][0] == want[1]
    assert max(d for _, d in got.values()) > 3
