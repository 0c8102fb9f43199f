"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JIT leaves methods of over 8,000 bytes of code to the interpreter, so
    # larger generated ones are slower than the operators they replace.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Reliable checkpoints are removed once their DataFrame is garbage
    # collected, so the shared checkpoint folder does not grow run by run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cohortkit", extra: dict | None = None,
                local_memory: str = "8g") -> SparkSession:
    """Build (or reuse) a session with AQE, UTC and no web UI.

    On a cluster pass ``master=None`` and let spark-submit decide.  In
    local mode the driver JVM is also every executor, so it gets
    ``local_memory`` of heap instead of the 1g default.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", local_memory)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (local tests)
    do we create a private scratch folder and register it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # Unset: only happens in local tests.
    d = tempfile.mkdtemp(prefix="cohortkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, max_partitions: int = 1_000_000) -> dict:
    """Settings sized for an input of ``input_bytes`` on a cluster.

    Shuffle partitions aim at ``target_partition_bytes`` of (compressed
    input) data each, so a task's sort and aggregation buffers fit in
    executor memory and spill rarely; AQE then coalesces small ones and
    splits skewed ones against the same advisory size.
    """
    parts = max(200, min(max_partitions, -(-int(input_bytes) // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
