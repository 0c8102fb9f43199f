"""Sinks (S07–S11).  Every write is a distributed Spark write; nothing is
gathered on the driver except tiny metric tables."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Table sink (Parquet by default; CSV with a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def metrics_frame(spark: SparkSession, metrics: dict, prefix: str = "") -> DataFrame:
    """Flatten a nested metrics dict into ``(metric, value)`` rows; numpy and
    other numbers become doubles, everything else text."""
    rows = []

    def walk(d, p):
        for k, v in d.items():
            name = f"{p}.{k}" if p else str(k)
            if isinstance(v, dict):
                walk(v, name)
            else:
                rows.append((name, _num(v), None if _num(v) is not None else (None if v is None else str(v))))
    walk(metrics, prefix)
    return spark.createDataFrame(rows, "metric string, value double, text string")


def _num(v):
    try:
        if isinstance(v, bool):
            return float(v)
        f = float(v)
        return None if math.isnan(f) else f
    except (TypeError, ValueError):
        return None


def write_metrics(df_or_dict, path: str, spark: SparkSession | None = None) -> None:
    """Metrics as JSON lines (a tidy DataFrame, or a dict flattened)."""
    df = df_or_dict if isinstance(df_or_dict, DataFrame) else metrics_frame(spark, df_or_dict)
    df.coalesce(1).write.mode("overwrite").json(path)


def write_feature_list(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """One-column ``feature`` CSV."""
    spark.createDataFrame([(n,) for n in names], "feature string").coalesce(1).write.mode(
        "overwrite").option("header", True).csv(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """Names from a feature-list CSV (bounded: one row per feature)."""
    return [r[0] for r in spark.read.option("header", True).csv(path).collect()]


def write_importances(df: DataFrame, path: str) -> None:
    """Importance tables as CSV."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """Spark ML persistence (a directory readable by ``load_model``)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def dumps_metrics(metrics: dict) -> str:
    return json.dumps(metrics, default=lambda o: _num(o) if _num(o) is not None else str(o))
