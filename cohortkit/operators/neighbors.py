"""Exact nearest neighbours in a partitioned metric index.

``build_index`` cuts points into the cells of pivots (a fitted sample of bounded size) and keeps, per cell and
tag, the number of points, their least and largest distance to the pivot and their box.  By the triangle inequality, the plane half way
to a query's own pivot and the distance to the box, these give a lower bound on the distance from a query to every cell.

``knn`` sends each query to the cell with the least bound, then in rounds of growing size
only to further cells whose bound does not exceed the k-th distance it has found so far, and stops when none is left.
Of each visited cell at most k points per query are handed on, so the pairs never
exceed k per query and visited piece.

Cells larger than ``piece_rows`` are met in pieces, as are the queries of a cell, so no task holds
more than a piece of either.  The driver sees pivots and one row per cell and tag.

Points with a null, NaN or infinite coordinate take no part.  Equal distances are ordered by key.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.session import checkpoint_dir

# The functions below go to executors by value, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VEC, TAG, UNIT, PIECE, PART = "_ck_vec", "_ck_tag", "_ck_unit", "_ck_piece", "_ck_part"


@dataclass
class MetricIndex:
    rows: DataFrame            # key..., vector, unit, piece
    key: list[str]
    pivots: np.ndarray
    pivot_of: np.ndarray       # per unit (a cell's points of one tag): its pivot,
    tags: list                 # its tag (None: the index has none),
    least: np.ndarray          # and the distances of its points to the pivot
    most: np.ndarray
    pieces: list[int]
    low: np.ndarray            # and per coordinate the least and largest value of its points
    high: np.ndarray


def matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    flat = np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2.0 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0.0))


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """Means of the cells of ``n`` sample points: dense regions hold more sample points and so get more cells."""
    distinct = np.unique(sample, axis=0)
    pivots = distinct[np.linspace(0, len(distinct) - 1, min(n, len(distinct))).astype(int)]
    for _ in range(rounds):
        cell = to_pivots(sample, pivots).argmin(1)
        held = np.unique(cell)
        pivots = np.array([sample[cell == i].mean(0) for i in held])
    return pivots


def vector_of(cols: Sequence[str], scales: Sequence[float] | None = None) -> Column:
    """The columns as an array of doubles, each divided by its scale."""
    scales = scales or [1.0] * len(cols)
    return F.array(*[F.col(c).cast("double") / F.lit(float(s)) for c, s in zip(cols, scales)])


def _finite(vec: str) -> Column:
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def build_index(points: DataFrame, vec: Column, key: Sequence[str], tag: Column | None = None, cells: int | None = None,
                sample: int = 4096, piece_rows: int = 8192) -> MetricIndex:
    """Index ``points`` by ``vec`` (an array of doubles); ``key`` identifies a row, ``tag`` is a label of few values."""
    checkpoint_dir(points.sparkSession)
    key = list(key)
    rows = points.select(*key, vec.alias(VEC), (tag if tag is not None else F.lit(0)).alias(TAG)).where(_finite(VEC))
    n = rows.count()
    picked = rows.orderBy(F.xxhash64(*key)).limit(sample).select(VEC).toArrow()[VEC]
    if not n:
        return MetricIndex(rows.select(*key, VEC, F.lit(0).alias(UNIT), F.lit(0).alias(PIECE)), key, np.zeros((0, 0)), np.zeros(0, int), [], np.zeros(0), np.zeros(0), [], np.zeros((0, 0)), np.zeros((0, 0)))
    pivots = fit_pivots(matrix(picked), cells or max(1, min(1024, int(n ** 0.5 / 4))))

    def place(batches):
        for b in batches:
            far = to_pivots(matrix(b[VEC]), pivots) if b.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(far.argmin(1).astype(np.int32)), pa.array(far.min(1))],
                                             names=[*b.schema.names, "_ck_cell", "_ck_dist"])

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, _ck_cell int, _ck_dist double"
    placed = rows.mapInArrow(place, schema).checkpoint(eager=True)
    units = placed.groupBy("_ck_cell", TAG).agg(F.count(F.lit(1)).alias("n"), F.min("_ck_dist").alias("least"), F.max("_ck_dist").alias("most"),
                                                   *[f(F.col(VEC)[i]).alias(f"{side}{i}") for side, f in (("low", F.min), ("high", F.max)) for i in range(pivots.shape[1])]).collect()
    units.sort(key=lambda u: (u["_ck_cell"], str(u[TAG])))
    pieces = [-(-u["n"] // piece_rows) for u in units]
    numbers = points.sparkSession.createDataFrame([(u["_ck_cell"], u[TAG], i, p) for i, (u, p) in enumerate(zip(units, pieces))],
                                                  f"_ck_cell int, {TAG} {rows.schema[TAG].dataType.simpleString()}, {UNIT} int, _ck_pieces int")
    # One row per cell and tag: at most 1,024 cells unless the caller asks for more.
    numbered = placed.join(F.broadcast(numbers), (placed["_ck_cell"] == numbers["_ck_cell"]) & placed[TAG].eqNullSafe(numbers[TAG]))
    indexed = numbered.select(*key, VEC, UNIT, F.pmod(F.xxhash64(*key), F.col("_ck_pieces")).cast("int").alias(PIECE))
    return MetricIndex(indexed, key, pivots, np.array([u["_ck_cell"] for u in units]), [u[TAG] for u in units],
                       np.array([u["least"] for u in units]), np.array([u["most"] for u in units]), pieces,
                       *[np.array([[u[f"{side}{i}"] for i in range(pivots.shape[1])] for u in units]) for side in ("low", "high")])


def lower_bounds(points: np.ndarray, index_pivots: np.ndarray, pivot_of: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each point and unit a distance that none of the unit's points goes below."""
    far = to_pivots(points, index_pivots)
    own = far.argmin(1)
    apart = to_pivots(index_pivots, index_pivots)[own]
    plane = np.divide(far ** 2 - far.min(1)[:, None] ** 2, 2 * apart, out=np.zeros_like(far), where=apart > 0)
    at = far[:, pivot_of]
    bound = np.maximum(np.maximum(at - most, least - at), plane[:, pivot_of])
    slack = 1e-7 * (1.0 + np.abs(points).max(1, initial=0.0) + np.abs(index_pivots).max(initial=0.0))
    return np.maximum(bound - slack[:, None], 0.0)


def box_bounds(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each point and unit its distance to the box of the unit's points."""
    squares = np.zeros((len(points), len(low)))
    for i in range(points.shape[1]):
        x = points[:, i, None]
        out = np.maximum(low[:, i] - x, x - high[:, i])
        np.maximum(out, 0.0, out=out)
        squares += out * out
    # The sums' rounding stays far below this share.
    return np.sqrt(squares) * (1 - 1e-9)


def nearest_of(queries: np.ndarray, points: np.ndarray, k: int, within: np.ndarray | None = None):
    """(query, point, distance) of the k nearest points to each query, in order; of equally near the earlier point.
    Points farther than a query's ``within`` may be left out."""
    out, k = [], min(k, len(points))
    # The working set of a step stays in a core's cache.
    squares, step = (points ** 2).sum(1), max(1, (1 << 17) // max(1, len(points)))
    turned, width = np.ascontiguousarray(-2.0 * points.T), max(1, min(64, len(points) // max(1, 4 * k)))
    whole = len(points) // width * width
    for at in range(0, len(queries) if k else 0, step):
        q = queries[at:at + step]
        norms = (q ** 2).sum(1)
        rough = q @ turned
        rough += squares
        rough += norms[:, None]
        # k runs of points each hold one no farther than the k-th least of the runs' minima: as many points lie within it.
        least = rough[:, :whole].reshape(len(q), -1, width).min(2) if width > 1 else rough
        # The product form loses digits, so all that may be among the k nearest are measured again.
        slack = 1e-9 * (norms + squares.max())
        cut = np.partition(least, k - 1, 1)[:, k - 1] + slack
        if within is not None:
            cut = np.minimum(cut, within[at:at + step] ** 2 * (1 + 1e-9) + slack)
        of, to = np.nonzero(rough <= cut[:, None])
        dist = np.concatenate([np.zeros(0), *[((q[of[i:i + (1 << 18)]] - points[to[i:i + (1 << 18)]]) ** 2).sum(1) for i in range(0, len(of), 1 << 18)]])
        order = np.lexsort((to, dist, of))
        of, to, dist = of[order], to[order], dist[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        out.append((of[rank < k] + at, to[rank < k], np.sqrt(dist[rank < k])))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def knn(index: MetricIndex, queries: DataFrame, vec: Column, k: int, tag: Column | None = None, piece_queries: int = 8192) -> DataFrame:
    """``key..., rank, nn_key..., distance``: the ``k`` nearest indexed points of each query, itself (the
    point with its key) excluded.  With ``tag`` only points with another tag than the query's count (null is a tag)."""
    spark, key = queries.sparkSession, index.key
    types = {c: index.rows.schema[c].dataType.simpleString() for c in key}
    found_schema = ", ".join([f"`{c}` {types[c]}" for c in key] + [f"`nn_{c}` {types[c]}" for c in key] + ["distance double"])
    best = spark.createDataFrame([], found_schema)
    asking = queries.select(*key, vec.alias(VEC), (tag if tag is not None else F.lit(None).cast("int")).alias(TAG)).where(_finite(VEC)).withColumn("_ck_kth", F.lit(float("inf")))
    pivots, pivot_of, least, most, tags, other = index.pivots, index.pivot_of, index.least, index.most, index.tags, tag is not None
    low, high = index.low, index.high
    visit_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in asking.schema.fields] + [f"{UNIT} int"])
    seen, step = 0, 1
    while seen < len(tags):
        def visits(batches, seen=seen, step=step):
            for b in batches:
                # Bounds to every unit are held for few queries at a time.
                for at in range(0, b.num_rows, 512):
                    some = b.slice(at, 512)
                    asked = matrix(some[VEC])
                    bound = np.maximum(lower_bounds(asked, pivots, pivot_of, least, most), box_bounds(asked, low, high))
                    if other:
                        mine = some[TAG].dictionary_encode()
                        alike = np.array([[t == u for u in tags] for t in [*mine.dictionary.to_pylist(), None]])
                        bound[alike[np.asarray(mine.indices.fill_null(len(mine.dictionary)))]] = np.inf
                    order = np.argsort(bound, 1, kind="stable")[:, seen:seen + step]
                    near = np.take_along_axis(bound, order, 1)
                    rows, places = np.nonzero((near <= np.asarray(some["_ck_kth"])[:, None]) & np.isfinite(near))
                    part = some.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(order[rows, places].astype(np.int32))], names=[*part.schema.names, UNIT])

        sent = asking.mapInArrow(visits, visit_schema).checkpoint(eager=True)
        load = {r[UNIT]: r["n"] for r in sent.groupBy(UNIT).agg(F.count(F.lit(1)).alias("n")).collect()}
        if not load:
            break
        parts = [-(-load.get(u, 0) // piece_queries) for u in range(len(tags))]
        left = sent.withColumn(PART, F.pmod(F.xxhash64(*key), F.element_at(F.lit(parts), F.col(UNIT) + 1)).cast("int")).withColumn(
            PIECE, F.explode(F.sequence(F.lit(0), F.element_at(F.lit(index.pieces), F.col(UNIT) + 1).cast("int") - 1)))
        right = index.rows.withColumn("_ck_parts", F.element_at(F.lit(parts), F.col(UNIT) + 1).cast("int")).where("_ck_parts > 0").withColumn(
            PART, F.explode(F.sequence(F.lit(0), F.col("_ck_parts") - 1)))

        def meet(left, right):
            right = right.sort_by([(c, "ascending") for c in key])
            asked, points = (matrix(t[VEC]) if t.num_rows else np.zeros((0, 0)) for t in (left, right))
            of, to, dist = nearest_of(asked, points, k + 1, np.asarray(left["_ck_kth"])) if left.num_rows and right.num_rows else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
            # What lies beyond the k-th distance found so far is not handed on.
            keep = dist <= np.asarray(left["_ck_kth"])[of]
            of, to, dist = of[keep], to[keep], dist[keep]
            a, b = left.select(key).take(pa.array(of)), right.select(key).take(pa.array(to))
            itself = np.ones(len(of), bool)
            for c in key:
                # As for Python values: null is null, and NaN is not NaN.
                x, y = a[c].combine_chunks(), b[c].combine_chunks()
                itself &= np.asarray(pc.fill_null(pc.equal(x, y), False)) | np.asarray(pc.and_(x.is_null(), y.is_null()))
            return pa.table([*[a[c] for c in key], *[b[c] for c in key], pa.array(dist)], names=[*key, *[f"nn_{c}" for c in key], "distance"]).filter(pa.array(~itself))

        pairs = left.groupBy(UNIT, PIECE, PART).cogroup(right.groupBy(UNIT, PIECE, PART)).applyInArrow(meet, found_schema)
        order = Window.partitionBy(*key).orderBy("distance", *[f"nn_{c}" for c in key])
        best = best.unionByName(pairs).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank").checkpoint(eager=True)
        kth = best.groupBy(*[F.col(c).alias(f"_ck_of_{c}") for c in key]).agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("_ck_kth"))
        same = [F.col(c).eqNullSafe(F.col(f"_ck_of_{c}")) for c in key]
        asking = sent.drop(UNIT, "_ck_kth").dropDuplicates(key).join(kth, same, "left").select(*key, VEC, TAG, F.coalesce("_ck_kth", F.lit(float("inf"))).alias("_ck_kth"))
        seen, step = seen + step, step * 4
    order = Window.partitionBy(*key).orderBy("distance", *[f"nn_{c}" for c in key])
    return best.withColumn("rank", F.row_number().over(order)).select(*key, "rank", *[f"nn_{c}" for c in key], "distance")
