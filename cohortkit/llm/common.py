"""Helpers shared by the operators: shared scratch tables, column clashes, Arrow texts."""

from __future__ import annotations

import os
import pickle
import sys
import tempfile
import types
import uuid

import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a local session without
    that setting gets a folder of its own; a cluster without it is an error,
    since its executors would not share one."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if at:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(at)
        return at
    if not (sc.master.startswith("local[") or sc.master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and reread: lineage ends here, every
    reader sees the same rows, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, want: str) -> str:
    """``want``, with underscores until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want += "_"
    return want


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (compared as Spark does, without case)."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def plus(schema: StructType, ddl: str) -> StructType:
    """A schema with the columns of ``ddl`` after its own (``StructType.add`` would change it in place)."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def id_key(name: str):
    """A never-null join key for an id column: null ids are equal to each other and to nothing else."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    name = "_cohortkit_llm_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


class Shipped:
    """A broadcast object of one of this package's classes, pickled by value; ``get`` it once per task."""

    def __init__(self, spark: SparkSession, value):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return pickle.loads(self.data.value)


def text_slices(column, max_bytes: int = 4 << 20):
    """(first row, list of UTF-8 byte strings) over an Arrow string column,
    each slice of about ``max_bytes`` at most or one row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = column.cast(pa.large_binary())
    n, begin, size = len(data), 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(data), 0).to_pylist() if n else []
    for i, k in enumerate(lengths):
        if i > begin and size + k > max_bytes:
            yield begin, [x or b"" for x in data.slice(begin, i - begin).to_pylist()]
            begin, size = i, 0
        size += k
    if n:
        yield begin, [x or b"" for x in data.slice(begin).to_pylist()]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is on this machine (driver or executor)."""
    import public_tokenizers
    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path
