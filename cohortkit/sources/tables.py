"""Reading the benchmark tables and typed CSV/Parquet sources."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads one Parquet table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.dir, name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS, object
    stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_named(spark: SparkSession, paths: dict[str, str], fmt: str = "csv",
               schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Read several named tables; fail fast if a path is missing.
    CSV is read with a header and, when given, an explicit schema (no
    inference pass)."""
    out = {}
    schemas = schemas or {}
    for name, path in paths.items():
        if not path_exists(spark, path):
            raise FileNotFoundError(f"{name}: {path}")
        r = spark.read
        if name in schemas:
            r = r.schema(schemas[name])
        if fmt == "csv":
            r = r.option("header", True).option("inferSchema", name not in schemas)
        out[name] = r.format(fmt).load(path)
    return out


def load_with_times(spark: SparkSession, path: str, time_cols: Sequence[str], fmt: str = "csv",
                    schema: T.StructType | None = None) -> DataFrame:
    """Read a table (declared ``schema``, else inferred) and parse
    the listed time columns present; unparseable text becomes NULL."""
    df = load_named(spark, {"t": path}, fmt, {"t": schema} if schema else None)["t"]
    present = set(c for c in time_cols if c in df.columns)
    return df.select(*[F.col(c).cast("string").try_cast("timestamp_ntz").alias(c) if c in present else F.col(c)
                       for c in df.columns])


def load_complete(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read, refuse an empty table, drop every row holding a NULL/NaN."""
    from cohortkit.operators.select import drop_any_null
    df = spark.read.format(fmt).option("header", True).option("inferSchema", True).load(path)
    if df.isEmpty():
        raise ValueError(f"empty input: {path}")
    return drop_any_null(df)


def project_features(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Keep the listed feature columns that exist (plus target);
    without a list, every column but the target."""
    if features:
        keep = [c for c in features if c in df.columns and c != target]
    else:
        keep = [c for c in df.columns if c != target]
    return df.select(*keep, *([target] if target and target in df.columns else []))
