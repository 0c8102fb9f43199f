"""Fits in tasks of a useful size, several at a time."""
from pyspark.sql import functions as F

from cohortkit.operators import ml


def test_fits_begin_no_task_per_shuffle_partition(spark):
    few = spark.range(100).repartition(40)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = ml.for_fits(few)
        assert got.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism and got.count() == 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_stacking_fits_several_models_at_a_time(spark, monkeypatch):
    import threading
    import time
    running, most, lock, make = [0], [0], threading.Lock(), ml.make_classifier

    class Watched:
        def __init__(self, est):
            self.est = est

        def fit(self, rows):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.2)
            try:
                return self.est.fit(rows)
            finally:
                with lock:
                    running[0] -= 1

    monkeypatch.setattr(ml, "make_classifier", lambda *a, **k: Watched(make(*a, **k)))
    df = spark.createDataFrame([(i, float(i % 7), float(i % 4), int(i % 7 > 3)) for i in range(80)], "id long, a double, b double, label int")
    bases, meta, oof = ml.stacking(df, ["a", "b"], bases=("logistic",), folds=3)
    assert most[0] > 1 and len(bases) == 1
    assert sorted(r["id"] for r in oof.select("id").collect()) == list(range(80))
    # Every fold's rows are scored by the model of the other folds.
    data = ml.assemble(ml.stratified_folds(df, "label", ["id"], 3, 42, name="f"), ["a", "b"])
    model = make("logistic", "features", "label", None, 42).fit(data.where(F.col("f") != 1))
    want = {r["id"]: r["score"] for r in ml.score(model, data.where(F.col("f") == 1)).collect()}
    got = {r["id"]: r["s_logistic"] for r in oof.collect() if r["id"] in want}
    assert want and all(abs(got[i] - want[i]) < 1e-9 for i in want)
