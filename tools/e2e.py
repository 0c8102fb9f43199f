"""Five stage drivers end to end on hospital-shaped tables derived from the
test data: preprocess -> engineer -> eda -> train -> interpret.

    python tools/e2e.py [/root/testdata/sf0.01]
"""
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F
from cohortkit.session import get_session
from cohortkit.plans import stages
from cohortkit.sources import sinks
spark = get_session("local[8]", 8)
SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
o = spark.read.parquet(f"{SF}/orders.parquet"); c = spark.read.parquet(f"{SF}/customer.parquet"); li = spark.read.parquet(f"{SF}/lineitem.parquet")
adm = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"), F.col("o_orderdate").alias("ADMITTIME"),
               (F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, cast(o_totalprice % 20 as int), 3)")).alias("DISCHTIME"),
               F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("DEATHTIME"),
               F.col("o_orderpriority").alias("insurance"), (F.col("o_orderstatus") == "F").cast("int").alias("hospital_expire_flag"))
pat = c.select(F.col("c_custkey").alias("subject_id"), "c_acctbal", "c_mktsegment")
labs = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
    F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"), "l_linenumber", "l_partkey", "l_suppkey",
    F.col("l_shipdate").alias("t"), F.col("l_quantity").alias("lab_value"))
out = tempfile.mkdtemp(prefix="ck-e2e-")
t0 = time.time()
processed, m = stages.preprocess(adm, pat, labs); print("preprocess", m, round(time.time()-t0, 1))
sinks.write_table(processed, f"{out}/processed"); processed = spark.read.parquet(f"{out}/processed")
t0 = time.time()
feats, reg = stages.engineer(processed, {"target_col": "hospital_expire_flag", "n_features": 10}, lab_order=["t", "l_linenumber", "l_partkey", "l_suppkey"])
sinks.write_table(feats, f"{out}/features"); feats = spark.read.parquet(f"{out}/features")
print("engineer", {k: len(v) for k, v in reg.items()}, feats.count(), len(feats.columns), round(time.time()-t0, 1))
t0 = time.time()
rep = stages.eda(feats.drop("subject_id", "hadm_id"), "hospital_expire_flag")
print("eda", {k: v.count() for k, v in rep.items()}, round(time.time()-t0, 1))
t0 = time.time()
metrics, best, fitted, names = stages.train(feats, "hospital_expire_flag", ["hadm_id"], config={"models": ("random_forest", "logistic")}, save_dir=f"{out}/models")
metrics.show(truncate=False); print("best", best, round(time.time()-t0, 1))
t0 = time.time()
x = stages.interpret(fitted["random_forest"], stages.sel.remap_binary_label(stages.sel.drop_any_null(feats), "hospital_expire_flag"), names, "hospital_expire_flag", ["hadm_id"], repeats=2)
x["report"].show(truncate=False); print("interpret", round(time.time()-t0, 1))
