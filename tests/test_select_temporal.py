import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortkit.functions import temporal as tm
from cohortkit.operators import select as sel


def test_stratified_split_disjoint_covering(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 3 = 0 as int) as y")
    s = sel.stratified_split(df, "y", ["id"], 0.8, seed=42)
    assert s.count() == 1000
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(1, "train")] == round(334 * 0.8) and c[(0, "train")] == round(666 * 0.8)
    again = sel.stratified_split(df, "y", ["id"], 0.8, seed=42)
    assert s.exceptAll(again).count() == 0


def test_folds_balanced(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 2 as int) as y")
    f = sel.stratified_folds(df, "y", ["id"], 3)
    sizes = [r["count"] for r in f.groupBy("y", "fold").count().collect()]
    assert sorted(set(sizes)) == [50]


def test_bootstrap_weights_mean_one(spark):
    df = spark.range(2000).selectExpr("id")
    b = sel.bootstrap(df, 5, ["id"], seed=1)
    tot = [r["s"] for r in b.groupBy("replicate").agg(F.sum("weight").alias("s")).collect()]
    assert all(1800 < t < 2200 for t in tot)


def test_remap_and_codes(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "c string")
    assert [r["c"] for r in sel.remap_binary_label(df, "c").collect()] == [0, 1, 0]
    with pytest.raises(ValueError):
        sel.remap_binary_label(spark.createDataFrame([("x",)], "c string"), "c")
    codes = sel.category_codes(df, "c", "code").orderBy("c").collect()
    assert [r["code"] for r in codes] == [0, 0, 1]


def test_feature_columns_exclude_ids_and_target():
    class D:  # only .columns is read
        columns = ["SUBJECT_ID", "hadm_id", "ADMITTIME", "age", "lab_x", "target", "row_nr"]
    assert sel.feature_columns(D, target="target") == ["age", "lab_x"]


@pytest.mark.parametrize("day, expected", [
    ("2024-01-01", True), ("2024-01-15", True), ("2024-01-16", False), ("2021-12-31", True),
    ("2022-12-26", True), ("2023-07-04", True), ("2023-11-23", True), ("2020-07-03", True),
    ("2021-06-18", True), ("2020-06-19", False), ("2024-05-27", True), ("2024-09-02", True),
    ("2024-10-14", True), ("2024-02-19", True), ("2024-03-01", False)])
def test_us_holidays(spark, day, expected):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(day),)], "t timestamp_ntz")
    assert df.select(tm.is_us_holiday("t")).first()[0] is expected


def test_temporal_features_and_validation(spark):
    rows = [("2024-01-06 10:00:00", "2024-01-08 22:00:00", None), ("bad", "2024-01-01 00:00:00", None),
            ("2024-02-01 00:00:00", "2024-01-01 00:00:00", "2099-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, d string, x string")
    v = tm.validate_temporal(df, "a", "d", "x", as_of="2030-01-01").collect()
    assert v[1]["a"] is None and v[2]["d"] is None and v[2]["x"] is None
    f = tm.temporal_features(tm.validate_temporal(df, "a", "d", "x", as_of="2030-01-01"), ["a"], admit="a",
                             disch="d").first()
    assert f["a_dayofweek"] == 5 and f["a_is_weekend"] == 1 and f["los_days"] == pytest.approx(2.5)
    assert f["a_hour_sin"] == pytest.approx(0.5)


def test_days_between_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 01:00:00", "2024-03-10 03:00:00"),
                                    ("2024-03-10 02:30:00", "2024-03-10 03:00:00")], "a string, b string").select(
            F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        assert [r[0] * 24 for r in df.select(tm.days_between("a", "b")).collect()] == [2.0, 0.5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
