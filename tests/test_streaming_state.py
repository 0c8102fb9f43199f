"""Stateful streams over several batches: late rows, rows out of order, a restart in between."""

import tempfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cohortkit.streaming import features as sf
from cohortkit.streaming import stateful as st

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "id bigint, k string, ts timestamp, v double"
FILES = [
    [(1, "a", 0.1, 5.0), (2, "a", 3.0, 1.0), (3, "b", 2.4, None), (4, "a", 2.6, 9.0), (5, None, 2.0, 1.0), (6, "c", None, 1.0)],
    [(7, "a", 2.8, 4.0), (8, "a", 0.5, 99.0), (9, "b", 5.0, 7.0), (10, "b", 2.5, 2.0), (11, "a", 3.0, 2.0), (1, "a", 2.9, 5.0)],
    [(12, "a", 9.0, 8.0), (13, "b", 5.0, 7.5), (14, "c", 30.0, 1.0)],
]


def day(x):
    return None if x is None else T0 + timedelta(days=x)


def fed(spark, build, around=None):
    """The rows of three files, each drained by a query that starts anew on the same checkpoint."""
    at = tempfile.mkdtemp(prefix="ck-state-")
    out = []
    for rows in FILES:
        df = spark.createDataFrame([(i, k, day(t), v) for i, k, t, v in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{at}/in")
        with st.rocksdb_state(spark):
            sf.run_once(build(sf.read_stream(spark, f"{at}/in", df.schema, max_files_per_trigger=1)), f"{at}/ck",
                        lambda b, e: out.extend(r.asDict() for r in b.collect()))
    return out


@pytest.fixture
def accepted():
    """Row 8 comes a day and a half behind the newest; rows 5 and 6 have no key or no time."""
    return [r for rows in FILES for r in rows if r[0] not in (5, 6, 8)]


def test_trend_over_batches(spark, accepted):
    got = fed(spark, lambda s: st.trend_stream(s, "k", "ts", ["v"], ["id"], "1 day"))
    want, last = set(), {}
    for i, k, t, v in sorted(accepted, key=lambda r: (r[2], r[0])):
        if t <= 29:  # the newest row is at day 30
            p = last.get(k)
            d = None if p is None or v is None else v - p
            want.add((i, k, t, d, None if d is None else (d > 0) - (d < 0)))
            last[k] = v
    have = [(r["id"], r["k"], round((r["ts"] - T0.replace(tzinfo=None)).total_seconds() / 86400, 6), r["v_trend"], r["v_trend_sign"]) for r in got]
    assert len(have) == len(set(have)) and set(have) == want


def test_distinct_over_batches(spark):
    got = fed(spark, lambda s: st.distinct_within(s.filter("ts IS NOT NULL"), "ts", ["k", "v"], "10 days"))
    keys = [(r["k"], r["v"]) for r in got]
    assert len(keys) == len(set(keys)) == len({(k, v) for rows in FILES for i, k, t, v in rows if t is not None})


def test_series_appends_closed_windows_once(spark, accepted):
    got = fed(spark, lambda s: st.closed_series(s.filter("ts IS NOT NULL AND k IS NOT NULL"), "ts", "1 day", "1 day", ["k"], "v"))
    want = {}
    for _, k, t, _ in accepted:
        if int(t) + 1 <= 29:
            want[k, int(t)] = want.get((k, int(t)), 0) + 1
    have = {(r["k"], (r["bucket"] - T0.replace(tzinfo=None)).days): r["n"] for r in got}
    assert len(got) == len(have) and have == want


def test_setting_comes_back(spark):
    before = spark.conf.get(st.PROVIDER, None)
    with st.rocksdb_state(spark):
        assert spark.conf.get(st.PROVIDER) == st.ROCKSDB
    assert spark.conf.get(st.PROVIDER, None) == before
