"""Rows kept for several passes lie on disk by column, and only the columns asked for."""
from pyspark.sql import DataFrame

from cohortkit.operators import clean


def _rows(spark):
    rows = [(i % 40, float(i % 40 % 7) if i % 40 % 5 else None, None if i % 40 % 8 == 0 else "x" * 30 + str(i % 40 % 2), i % 40 % 3) for i in range(80)]
    return spark.createDataFrame(rows, "id long, a double, t string, b int")


def test_cleaning_keeps_rows_in_a_file_by_column(spark, monkeypatch):
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: 1 / 0)
    out = clean.clean_data(_rows(spark), keys=["id"])
    assert out.inputFiles() and all(f.endswith(".zstd.parquet") for f in out.inputFiles())
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == out.count() == 40
    assert rows[0]["a"] == 3.0 and rows[0]["t"] == "x" * 30 + "1" and rows[1]["a"] == 1.0
    assert out.dtypes == [("id", "bigint"), ("a", "double"), ("t", "string"), ("b", "int")]


def test_medians_keep_columns_with_gaps_alone(spark, monkeypatch):
    kept, real = [], clean._persisted
    monkeypatch.setattr(clean, "_persisted", lambda df: kept.append(df.columns) or real(df))
    got = {r["id"]: r["a"] for r in clean.handle_missing(_rows(spark), "median", exclude=["id"]).collect()}
    assert kept == [["a"]] and got[5] == 3.0 and got[6] == 6.0
    clean.handle_missing(_rows(spark).select("id", "b"), "median")
    assert kept == [["a"]]  # nothing to fill, nothing kept


def test_rows_that_parquet_cannot_hold_are_checkpointed(spark):
    df = spark.range(3).selectExpr("id", "null as nothing", "interval 1 month as m")
    assert clean._persisted(df).count() == 3 and clean._persisted(df).dtypes == df.dtypes
