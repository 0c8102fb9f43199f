"""Five stage drivers end to end on hospital-shaped tables derived from the
test data (orders = admissions, customer = patients, lineitem = labs)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from cohortkit.plans import stages
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def hospital(spark):
    o = spark.read.parquet(f"{SF0001}/orders.parquet")
    c = spark.read.parquet(f"{SF0001}/customer.parquet")
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    adm = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                   F.col("o_orderdate").alias("ADMITTIME"),
                   (F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, cast(o_totalprice % 20 as int), 3)"))
                   .alias("DISCHTIME"),
                   F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
                   .alias("DEATHTIME"),
                   F.col("o_orderpriority").alias("insurance"), (F.col("o_orderstatus") == "F").cast("int")
                   .alias("hospital_expire_flag"))
    pat = c.select(F.col("c_custkey").alias("subject_id"), "c_acctbal", "c_mktsegment")
    labs = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"), "l_linenumber", "l_partkey",
        "l_suppkey", F.col("l_shipdate").alias("t"), F.col("l_quantity").alias("lab_value"))
    return adm, pat, labs


def test_pipeline(spark, hospital):
    adm, pat, labs = hospital
    processed, metrics = stages.preprocess(adm, pat, labs)
    assert metrics["rows"] == processed.count() > 0
    feats, reg = stages.engineer(processed, {"target_col": "hospital_expire_flag", "n_features": 6},
                                 lab_order=["t", "l_linenumber", "l_partkey", "l_suppkey"])
    assert reg["temporal"] and reg["lab"] and reg["categorical"] and reg["interactions"]
    assert set(feats.columns) >= {"subject_id", "hadm_id", "hospital_expire_flag"}
    assert len(feats.columns) == 9
    report = stages.eda(feats.drop("subject_id", "hadm_id"), "hospital_expire_flag", {"n_clusters": 2})
    assert report["missing"].count() == 7 and report["t_tests"].count() == 6
    out = tempfile.mkdtemp(prefix="ck-models-")
    m, best, fitted, names = stages.train(feats, "hospital_expire_flag", ["hadm_id"],
                                          config={"models": ("random_forest", "logistic")}, save_dir=out)
    assert m.count() == 2 and best in fitted
    x = stages.interpret(fitted["random_forest"], stages.sel.remap_binary_label(
        stages.sel.drop_any_null(feats), "hospital_expire_flag"), names, "hospital_expire_flag", ["hadm_id"], repeats=2)
    assert x["report"].count() >= 1


def test_unknown_balance_is_refused(spark):
    import pytest
    from cohortkit.plans import stages
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(8)], "id int, x double, label int")
    with pytest.raises(ValueError, match="balance"):
        stages.train(df, "label", ["id"], ["x"], {"balance_strategy": "other"})
