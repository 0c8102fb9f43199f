"""Work that the model queries share is done once."""
import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cohortkit.operators import evaluate as ev, ml, select as sel
from cohortkit.plans import catalog
from cohortkit.sources.tables import Tables
from tests.conftest import SF0001


def _counted(monkeypatch, owner, name):
    calls, f = [], getattr(owner, name)
    monkeypatch.setattr(owner, name, lambda *a, **k: calls.append(1) or f(*a, **k))
    return calls


def test_training_table_reads_each_table_once(spark):
    plan = catalog.admission_table(Tables(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == plan.count("orders.parquet") == plan.count("customer.parquet") == 1


def test_training_table_counts_repeated_admissions(spark):
    class T:
        orders = spark.createDataFrame([(1, 10, "F", 5.0, "1995-01-01 00:00:00"), (1, 10, "F", 5.0, "1995-01-03 12:00:00"), (2, 10, "O", 6.0, None), (3, 10, "O", 7.0, "1995-01-01 00:00:00")],
                                       "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string").selectExpr("* except(d)", "cast(d as timestamp_ntz) as o_orderdate")
        customer = spark.createDataFrame([(10, 1.5)], "c_custkey long, c_acctbal double")
        lineitem = spark.createDataFrame([(1, 2.0, 10.0, 0.5, "F", "1995-01-05 00:00:00"), (1, 4.0, None, 0.1, None, None), (2, 1.0, 1.0, 0.1, "F", "1995-01-05 00:00:00")],
                                         "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string, s string").selectExpr("* except(s)", "cast(s as timestamp_ntz) as l_shipdate")
    rows = [r.asDict() for r in catalog.admission_table(T).collect()]
    assert rows == [dict(id=1, o_totalprice=5.0, c_acctbal=1.5, n_lines=4.0, qty_mean=3.0, price_mean=10.0, disc_mean=0.3, share_f=1.0, los_mean=2.75, label=1)]


def test_evaluate_builds_one_table_of_scores(spark, monkeypatch):
    calls = _counted(monkeypatch, ev, "score_table")
    df = spark.range(100).selectExpr("cast(id % 2 as int) as label", "cast(id % 3 > 0 as int) as prediction", "(id * 37 % 100) / 100.0 as score")
    row = ev.evaluate(df).first()
    assert len(calls) == 1
    assert row["roc_auc"] == ev.roc_auc(df).first()[0] and row["pr_auc"] == ev.pr_auc(df).first()[0]


def test_models_share_a_split_and_trials_are_not_refitted(spark, monkeypatch):
    df = spark.range(240).select("id", (F.col("id") % 13).cast("double").alias("x"), ((F.col("id") * 7) % 5).cast("double").alias("y"),
                                 (F.col("id") % 13 > 5).cast("int").alias("label"))
    splits = _counted(monkeypatch, ml, "stratified_split")
    metrics, _, fitted = ml.train_and_evaluate(df, ["x", "y"], models=("logistic", "random_forest"))
    assert len(splits) == 1 and len(fitted) == metrics.count() == 2
    fits = _counted(monkeypatch, LogisticRegression, "fit")
    best, scores = ml.tune(ml.assemble(df, ["x", "y"]), "logistic", n_trials=2, folds=2, sampler="sequential")
    assert len(fits) == 2 * 2 + 1 and len(scores) == 2 and all(np.isfinite(scores)) and best.coefficients.size == 2


def test_split_by_bytes_orders_as_hex(spark):
    df = spark.range(50)
    a = [r[0] for r in df.orderBy(sel.hash_key(["id"], 42)).collect()]
    assert a == [r[0] for r in df.orderBy(F.unhex(sel.hash_key(["id"], 42))).collect()]
