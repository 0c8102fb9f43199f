"""Structured Streaming forms of the row-local operators.

The reference reads whole files only; here the same column expressions
(F01–F09, P04, P07) run unchanged on a streaming DataFrame, and the D05
time series becomes a watermarked windowed aggregation.  No operator needs
arbitrary state, so none uses ``applyInPandasWithState``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions import temporal as tm
from cohortkit.operators.select import inf_to_null


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_features(stream: DataFrame, time_cols: Sequence[str], admit: str | None = None,
                    disch: str | None = None, death: str | None = None) -> DataFrame:
    """F02–F07 + P07 on each micro-batch (pure projections, no state)."""
    return tm.temporal_features(inf_to_null(stream), list(time_cols), admit, disch, death)


def windowed_series(stream: DataFrame, ts: str, window: str = "1 day", watermark: str = "1 day",
                    labels: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """D05 on a stream: counts and means per event-time window and label;
    rows later than the watermark are dropped.  It bounds the state in
    ``append`` and ``update`` mode; ``complete`` mode keeps every window."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs += [F.avg(value).alias(f"{value}_mean"),
                 F.percentile_approx(value, 0.5, 10000).alias(f"{value}_median_approx")]
    g = stream.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("w"), *labels).agg(*aggs)
    return g.select(F.col("w.start").alias("bucket"), *labels, *[a for a in g.columns if a not in ("w", *labels)])


def run_once(stream: DataFrame, checkpoint: str, sink=None, output_mode: str = "append"):
    """Drain everything available (``availableNow``) into ``sink`` (a
    ``foreachBatch`` function) with a checkpoint in the shared folder, so
    a restarted job resumes exactly where it stopped."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.foreachBatch(sink) if sink else w.format("noop")
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
