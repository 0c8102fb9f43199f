"""Operators that need state on a stream: U01, W01/W02 and D05 with bounded state.

All three emit in ``append`` mode and drop rows behind the watermark, so a query may run for ever:

- ``distinct_within`` keeps a key until the watermark passes its time plus the delay;
- ``trend_stream`` keeps one row per key and the rows of the last ``watermark`` of event time;
- ``closed_series`` keeps the windows that the watermark has not closed.

State lives in RocksDB on the executors and in the query's checkpoint folder, so a restarted
query or a lost executor goes on where the last finished batch ended.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from cohortkit.streaming.features import windowed_series

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def distinct_within(stream: DataFrame, ts: str, subset: Sequence[str], watermark: str = "1 day") -> DataFrame:
    """U01 on a stream: the first row of each ``subset`` (nulls compare equal).  A repeat more than
    ``watermark`` of event time after the kept row may be kept again, since its key is forgotten."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(subset))


def closed_series(stream: DataFrame, ts: str, window: str = "1 day", watermark: str = "1 day",
                  labels: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """D05 on a stream for ``append``: each window once, when the watermark has passed its end."""
    return windowed_series(stream, ts, window, watermark, labels, value)


def _trend_processor(*args):
    """A class of a function's own is sent to the executors by value, so they need no copy of this module."""

    class Trend(StatefulProcessor):
        """Holds a key's rows until the watermark passes them, then hands them on in event order,
        each with the difference from the row before.  A key has one timer, at its earliest held row."""

        def __init__(self, key: list[str], names: list[str], held: T.StructType, n_cols: int):
            self.key, self.names, self.held, self.n_cols = key, names, held, n_cols

        def init(self, handle) -> None:
            self.handle = handle
            self.pending = handle.getListState("pending", self.held)
            self.last = handle.getValueState("last", self.held)

        def _wake(self, micros: int) -> None:
            self.handle.registerTimer(-(-int(micros) // 1000))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            last = self.last.get() if self.last.exists() else None
            earliest = None
            for part in rows:
                part = part.set_axis(self.names, axis=1)  # by place, since computed columns lose their names on the way here
                if last is not None:  # behind what is handed on already
                    part = part[part["_ck_us"] >= last[0]]
                if len(part):
                    self.pending.appendList([self._plain(r) for r in part[self.held.names].itertuples(index=False, name=None)])
                    low = int(part["_ck_us"].min())
                    earliest = low if earliest is None else min(earliest, low)
            if earliest is not None:
                self._wake(earliest)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            upto = timerValues.getCurrentWatermarkInMs() * 1000
            due, left = [], []
            for r in self.pending.get():
                (due if r[0] <= upto else left).append(tuple(r))
            if not due:
                return
            if left:
                self.pending.put(left)
                self._wake(min(r[0] for r in left))
            else:
                self.pending.clear()
            places = len(self.held) - self.n_cols
            due.sort(key=lambda r: [(x is not None, x) for x in r[:places]])
            before = tuple(self.last.get()) if self.last.exists() else None
            out = []
            for r in due:
                diffs = [None if before is None or r[i] is None or before[i] is None else r[i] - before[i] for i in range(places, len(r))]
                out.append([*key, *r, *diffs])
                before = r
            self.last.update(before)
            names = [*self.key, *self.held.names, *[f"{c}_trend" for c in self.held.names[places:]]]
            yield pd.DataFrame(out, columns=names)

        @staticmethod
        def _plain(row):
            return tuple(None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in row)

    return Trend(*args)


def trend_stream(stream: DataFrame, key: Sequence[str] | str, ts: str, cols: Sequence[str],
                 ties: Sequence[str] = (), watermark: str = "1 day") -> DataFrame:
    """W01/W02 on a stream: ``key, ts, ties, cols`` of each row, ``{col}_trend`` (value minus the previous
    value of its key by ``ts``, then ``ties``) and ``{col}_trend_sign``.

    Rows may come in any order within ``watermark``; each is emitted once, when the watermark has
    passed it.  Later ones are dropped, as are rows without a key or time.  Where the previous value is
    NULL or there is none, the trend is NULL.  ``ts`` is a zoned timestamp, ``cols`` become doubles.
    Run it under ``rocksdb_state``.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols, ties = list(cols), list(ties)
    rows = stream.filter(F.col(ts).isNotNull())
    for k in key:
        rows = rows.filter(F.col(k).isNotNull())
    rows = rows.withWatermark(ts, watermark).select(
        *key, ts, F.unix_micros(ts).alias("_ck_us"), *ties, *[F.col(c).cast("double").alias(c) for c in cols])
    held = T.StructType([f for f in rows.schema.fields if f.name not in (*key, ts)])
    held = T.StructType([T.StructField(f.name, f.dataType) for f in held])
    out = T.StructType([*[rows.schema[k] for k in key], *held.fields, *[T.StructField(f"{c}_trend", T.DoubleType()) for c in cols]])
    got = rows.groupBy(*key).transformWithStateInPandas(_trend_processor(key, rows.columns, held, len(cols)), out, "append", "EventTime")
    trends = [e for c in cols for e in (F.col(f"{c}_trend"), F.signum(f"{c}_trend").alias(f"{c}_trend_sign"))]
    return got.select(*key, F.timestamp_micros("_ck_us").alias(ts), *ties, *cols, *trends)
