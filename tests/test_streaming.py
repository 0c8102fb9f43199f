import tempfile

from pyspark.sql import functions as F

from cohortkit.streaming import features as sf
from tests.conftest import SF0001


def test_stream_matches_batch(spark):
    src = spark.read.parquet(f"{SF0001}/events.parquet")
    d = tempfile.mkdtemp(prefix="ck-stream-")
    src.repartition(3).write.mode("overwrite").parquet(f"{d}/in")
    stream = sf.read_stream(spark, f"{d}/in", src.schema, max_files_per_trigger=1)
    out = []

    def sink(batch, epoch):
        out.extend(batch.collect())

    feats = sf.stream_features(stream, ["ts"])
    sf.run_once(feats, f"{d}/ckpt", sink)
    assert len(out) == src.count()
    assert sum(r["ts_is_holiday"] for r in out) == src.where(F.to_date("ts").isin("2024-01-01", "2024-01-15")).count()


def test_windowed_series_runs(spark):
    src = spark.read.parquet(f"{SF0001}/events.parquet")
    d = tempfile.mkdtemp(prefix="ck-stream-")
    src.write.mode("overwrite").parquet(f"{d}/in")
    stream = sf.read_stream(spark, f"{d}/in", src.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    out = []
    sf.run_once(sf.windowed_series(stream, "ts", "1 day", "1 day", ["event_type"], "value"), f"{d}/ck",
                lambda b, e: out.extend(b.collect()), "append")
    assert sum(r["n"] for r in out) <= src.count()
