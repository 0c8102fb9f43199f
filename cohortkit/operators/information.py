"""Mutual information of a continuous column and a discrete target by the nearest-neighbour estimator.

With N rows, n_y of them of a row's class, r its distance to the k-th nearest row of that class and m the rows of any class
nearer than r (the row itself counts), the estimate is

    digamma(N) + mean digamma(k_y) - mean digamma(n_y) - mean digamma(m),   at least 0,

where k_y = min(k, n_y - 1).  A class of one row takes no part.  Where r is 0 (a value repeated more than k times in its class)
m counts the rows of equal value.  No noise is added to break ties, so the result is a function of the data.

How it stays distributed, for any class or value that holds most of the rows:

1. Equal (column, class, value) rows collapse in an aggregate combined before the shuffle.
2. The distinct values are cut into ranges of (column, class, value).  A value's k predecessors and successors come from a window inside its
   range; at the edges from a halo, the k last values of the ranges before and the k first of those after, which
   takes at most k rows per range and class.
3. A vectorised step finds r, and the least and the greatest value that are nearer than r (to the last bit, as the distance is
   rounded).
4. m is a difference of two counts along one order of values and bounds, by two-level prefix sums.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.ordered import cut_by_range, melt, prefix_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER = 0.57721566490153286061
#: Coefficients of the asymptotic series of digamma in 1/x^2.
SERIES = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132, -691 / 32760, 1 / 12)
#: At this argument and above the series is good to the last digits.
SHIFT = 10


def digamma(n: Column) -> Column:
    """Digamma of a positive whole number: shifted up by the recurrence, then the series."""
    small = F.when(n == 1, F.lit(-EULER))
    for i in range(2, SHIFT):
        small = small.when(n == i, F.lit(sum(1 / j for j in range(1, i)) - EULER))
    x = n.cast("double")
    squares, power = 1 / (x * x), F.lit(1.0)
    tail = F.lit(0.0)
    for c in SERIES:
        power = power * squares
        tail = tail + F.lit(c) * power
    return small.otherwise(F.log(x) - 0.5 / x - tail)


def kth_distance(value: np.ndarray, copies: np.ndarray, near: np.ndarray, counts: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Distance to the k-th nearest other row of the class; ``near`` are neighbouring distinct values (NaN: none) held by ``counts`` rows."""
    gaps = np.abs(near - value[:, None])
    gaps[np.isnan(gaps)] = np.inf
    order = np.argsort(gaps, 1, kind="stable")
    gaps = np.column_stack([np.zeros(len(value)), np.take_along_axis(gaps, order, 1)])
    held = np.cumsum(np.column_stack([copies - 1, np.take_along_axis(counts, order, 1)]), 1)
    return np.take_along_axis(gaps, (held >= k[:, None]).argmax(1)[:, None], 1)[:, 0]


def _ranked(x: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order."""
    bits = x.view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _unranked(i: np.ndarray) -> np.ndarray:
    return np.where(i >> np.uint64(63), i & np.uint64((1 << 63) - 1), ~i).view(np.float64)


def nearer(value: np.ndarray, radius: np.ndarray, sign: int) -> np.ndarray:
    """The furthest double to one side whose rounded distance from ``value`` is under ``radius``, by halving the doubles between."""
    with np.errstate(over="ignore"):
        value = sign * value + 0.0
        inside, outside = _ranked(value), _ranked(np.minimum(value + 2 * radius, np.finfo(float).max))
        while (outside - inside > 1).any():
            middle = inside + (outside - inside) // np.uint64(2)
            near = (_unranked(middle) - value < radius) & (outside - inside > 1)
            inside, outside = np.where(near, middle, inside), np.where(near, outside, middle)
    return np.where(radius > 0, sign * _unranked(inside), sign * value) + 0.0


def _neighbourhoods(values: DataFrame, k: int, ranges: int) -> DataFrame:
    """Each distinct (column, class, value) with ``before`` and ``after``: its up to k neighbours on each side, (value, copies)."""
    group = ["column", "_ck_y"]
    cut = cut_by_range(values, [*group, "value"], ranges, "_ck_range")
    point = F.struct("value", "copies")
    inside = Window.partitionBy(*group, "_ck_range").orderBy("value")
    rows = cut.select("*", F.collect_list(point).over(inside.rowsBetween(-k, -1)).alias("before"), F.collect_list(point).over(inside.rowsBetween(1, k)).alias("after"))
    first = cut.withColumn("_ck_i", F.row_number().over(inside)).where(F.col("_ck_i") <= k).groupBy(*group, "_ck_range").agg(F.sort_array(F.collect_list(point)).alias("head"))
    backward = Window.partitionBy(*group, "_ck_range").orderBy(F.col("value").desc())
    last = cut.withColumn("_ck_i", F.row_number().over(backward)).where(F.col("_ck_i") <= k).groupBy(*group, "_ck_range").agg(F.sort_array(F.collect_list(point)).alias("tail"))
    # One row per range and class; k ranges to either side hold k values.
    along = Window.partitionBy(*group).orderBy("_ck_range")
    halo = first.join(last, [*group, "_ck_range"]).select(
        *group, "_ck_range", F.slice(F.reverse(F.flatten(F.collect_list("tail").over(along.rowsBetween(-k, -1)))), 1, k).alias("halo_before"),
        F.slice(F.flatten(F.collect_list("head").over(along.rowsBetween(1, k))), 1, k).alias("halo_after"))
    rows = rows.join(halo, [*group, "_ck_range"])
    return rows.select(*group, "value", "copies", F.slice(F.concat(F.reverse("before"), "halo_before"), 1, k).alias("before"),
                       F.slice(F.concat("after", "halo_after"), 1, k).alias("after"))


def _padded(lists, k: int):
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths(), int)
    flat, there = lists.flatten(), np.arange(k) < sizes[:, None]
    values, counts = np.full((len(sizes), k), np.nan), np.zeros((len(sizes), k), np.int64)
    values[there], counts[there] = np.asarray(flat.field("value")), np.asarray(flat.field("copies"))
    return values, counts


def knn_mutual_information(df: DataFrame, target: str, cols: Sequence[str], k: int = 3, num_partitions: int | None = None) -> DataFrame:
    """``feature, mutual_info`` (nats) for every column with at least one class of two rows; rows with a null or NaN value or a
    null target are left out of that column."""
    cols = [c for c in cols if c != target]
    spark = df.sparkSession
    ranges = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = melt(df.where(F.col(target).isNotNull()).withColumn("_ck_y", F.col(target)), cols, by=["_ck_y"])
    values = long.withColumn("value", F.col("value") + F.lit(0.0)).groupBy("column", "_ck_y", "value").agg(F.count(F.lit(1)).alias("copies"))
    sizes = values.groupBy("column", "_ck_y").agg(F.sum("copies").alias("n_y")).where(F.col("n_y") > 1)
    values = values.join(sizes, ["column", "_ck_y"]).withColumn("k_y", F.least(F.lit(k), F.col("n_y") - 1)).checkpoint(eager=True)

    def bounds(batches):
        for b in batches:
            left, n_left = _padded(b["before"], k)
            right, n_right = _padded(b["after"], k)
            value, copies, want = (np.asarray(b[c]) for c in ("value", "copies", "k_y"))
            radius = kth_distance(value, copies, np.column_stack([left, right]), np.column_stack([n_left, n_right]), want)
            yield pa.RecordBatch.from_arrays([b["column"], b["_ck_y"], b["value"], b["copies"], pa.array(nearer(value, radius, -1)), pa.array(nearer(value, radius, 1))],
                                             names=["column", "_ck_y", "value", "copies", "low", "high"])

    y_type = values.schema["_ck_y"].dataType.simpleString()
    near = _neighbourhoods(values.select("column", "_ck_y", "value", "copies"), k, ranges).join(values.select("column", "_ck_y", "value", "k_y"), ["column", "_ck_y", "value"])
    near = near.mapInArrow(bounds, f"column string, _ck_y {y_type}, value double, copies bigint, low double, high double").checkpoint(eager=True)

    # Along one order: lower bounds before the values they equal, upper bounds after them.
    event = lambda at, kind, n: F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), n.alias("n"))
    events = near.select("column", "_ck_y", "value", "copies", F.explode(F.array(
        event("low", 0, F.lit(0).cast("bigint")), event("value", 1, F.col("copies")), event("high", 2, F.lit(0).cast("bigint")))).alias("e")).select("*", "e.*").drop("e")
    counted = prefix_sums(events, ["column", "at", "kind"], {"upto": F.col("n")}, by=["column"], num_partitions=ranges).where("kind <> 1")
    m = counted.groupBy("column", "_ck_y", "value").agg(F.first("copies").alias("copies"), F.sum(F.when(F.col("kind") == 2, F.col("upto")).otherwise(-F.col("upto"))).alias("m"))
    m = m.groupBy("column").agg(F.sum(F.col("copies") * digamma(F.col("m"))).alias("sum_m"))
    classes = values.groupBy("column", "_ck_y").agg(F.first("n_y").alias("n_y"), F.first("k_y").alias("k_y"))
    classes = classes.groupBy("column").agg(F.sum("n_y").alias("n"), F.sum(F.col("n_y") * (digamma(F.col("k_y")) - digamma(F.col("n_y")))).alias("sum_y"))
    score = digamma(F.col("n")) + (F.col("sum_y") - F.col("sum_m")) / F.col("n")
    return classes.join(m, "column").select(F.col("column").alias("feature"), F.greatest(score, F.lit(0.0)).alias("mutual_info"))
