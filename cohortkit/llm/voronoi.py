"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors are scaled to integers.  With M the largest norm, a data vector s becomes the point
(s, sqrt(M^2 - |s|^2)) and a query q the point (q, 0); then |q - s|^2 = |q|^2 + M^2 - 2 q.s, so the
nearest points are the largest products.

1. ``choose_pivots`` fits pivots on a bounded sample of distinct vectors; every row is placed in the cell of its
   nearest pivot and keeps its distance to it.
2. Queries of near cells form groups of about ``group_queries`` (a large cell is cut into several groups).
3. Each query meets one chunk of its own cell.  The k-th score there gives a radius that holds its
   answers, and with the query's distances to the pivots a ring of distances for every cell; a cell wholly
   behind a bisecting plane gets none.  The widest ring per (group, cell) is the summary.
4. A data row is sent to a group only where its distance to its own pivot lies in the ring of its cell.
5. Groups meet the rows sent to them in parts of about ``part_rows`` and keep the best of each part;
   a window over queries merges them.

The pivots, and the number of rows of each cell, are all that reaches the driver.  Memory per task is one part
and one group; hot cells are cut into chunks, groups and parts, never dropped.  When vectors are spread so
evenly that no ring excludes anything, every row goes to every group: the result stays exact.

Defined cases: a null vector or one with a null, NaN or infinite component takes no part (as query
or as candidate); components that a shorter vector lacks count as 0; an empty vector scores 0.  Equal scores
are ranked by id, null last.  Rows repeated with the same id and vector are each a candidate of the others
and each get an answer of their own.  Columns other than id and vector are ignored.  No usable row gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from .common import stored

#: Products below the first are exact in doubles; times the number of rows below the second, they fit a 64-bit key with a row number.
EXACT, KEYS = 2.0 ** 52, 2.0 ** 62


def floored(rows: pa.Array, scale: int, dim: int) -> np.ndarray:
    """The rows of a list array as a matrix of whole doubles, padded with zeros to ``dim``."""
    lengths = np.asarray(rows.value_lengths().fill_null(0), np.int64)
    flat = np.floor(np.asarray(rows.flatten(), np.float64) * scale)
    if len(flat) == len(lengths) * dim:
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def unpack(column, dim: int) -> np.ndarray:
    """Packed vectors back into a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), dim)


def distances(points: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of points, each with its additional coordinate, to the pivots."""
    full = np.column_stack([points, extra])
    squares = (full ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2.0 * (full @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def lift(points: np.ndarray, top: float) -> np.ndarray:
    """The additional coordinate of data vectors; ``top`` is the largest square of a norm."""
    return np.sqrt(np.maximum(top - (points ** 2).sum(1), 0.0))


def choose_pivots(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """At most ``n`` pivots: points far from each other, then moved to the means of their cells."""
    sample = np.unique(sample, axis=0)
    chosen, near = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(n, len(sample)):
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(near.argmax()))
    pivots = sample[chosen].copy()
    for _ in range(rounds):
        cell = distances(sample[:, :-1], sample[:, -1], pivots).argmin(1)
        for i in np.unique(cell):
            pivots[i] = sample[cell == i].mean(0)
    return pivots


def top_of(queries: np.ndarray, data: np.ndarray, k: int):
    """(positions, scores) of the ``k`` best rows of ``data`` for each query, best first; ties to the earlier row."""
    n, k = len(data), min(k, len(data))
    places, scores = np.zeros((len(queries), k), np.int64), np.zeros((len(queries), k), object)
    if not n or not len(queries):
        return places, scores
    most = np.sqrt((queries ** 2).sum(1).max()) * np.sqrt((data ** 2).sum(1).max())
    if most >= EXACT or most * n >= KEYS:  # whole numbers too large for doubles
        whole = [[int(x) for x in row] for row in data]
        for i, q in enumerate(queries):
            own = [sum(int(a) * b for a, b in zip(q, row)) for row in whole]
            places[i] = sorted(range(n), key=lambda j: (-own[j], j))[:k]
            scores[i] = [own[j] for j in places[i]]
        return places, scores
    scores = np.zeros((len(queries), k), np.int64)
    back, step = np.arange(n - 1, -1, -1), max(1, (1 << 22) // n)
    for at in range(0, len(queries), step):
        keys = (queries[at:at + step] @ data.T).astype(np.int64) * n + back  # unique, so ties are settled
        best = np.argpartition(keys, n - k, 1)[:, n - k:] if k < n else np.tile(np.arange(n), (len(keys), 1))
        order = np.argsort(-np.take_along_axis(keys, best, 1), 1)
        best = np.take_along_axis(best, order, 1)
        places[at:at + step] = best
        scores[at:at + step] = np.take_along_axis(keys, best, 1) // n
    return places, scores


def rings(queries: np.ndarray, kth: np.ndarray, pivots: np.ndarray, top: float, slack: float):
    """For each query and cell the least and largest distance to the cell's pivot that an answer of the query can
    have there (least over largest: none).  ``kth``: a score that enough rows are known to reach, -inf if none is."""
    far = distances(queries, np.zeros(len(queries)), pivots)
    radius = np.sqrt(np.maximum((queries ** 2).sum(1) + top - 2.0 * kth, 0.0))[:, None] + slack
    low, high = far - radius, far + radius
    apart = distances(pivots[:, :-1], pivots[:, -1], pivots)
    for i in range(len(pivots)):
        gap = np.where(apart[i] > 0, apart[i], np.inf)
        low[(far ** 2 - far[:, i:i + 1] ** 2) / (2 * gap) > radius] = np.inf  # behind the plane between i and the cell
    return low, high


def pack_groups(counts: dict[int, int], pivots: np.ndarray, size: int) -> tuple[list[int], list[int], int]:
    """Per cell its first group and its number of groups; small cells near each other share one."""
    first, pieces, group, room = [0] * len(pivots), [1] * len(pivots), -1, 0
    left, at = set(range(len(pivots))), 0
    while left:
        at = min(left, key=lambda c: (float(((pivots[c] - pivots[at]) ** 2).sum()), c))
        left.discard(at)
        n = counts.get(at, 0)
        if n > size:
            pieces[at], first[at] = -(-n // size), group + 1
            group, room = group + pieces[at], 0
            continue
        if n > room or group < 0:
            group, room = group + 1, size
        first[at], room = group, room - n
    return first, pieces, group + 1


def _pick(values: list, column: str) -> Column:
    return F.element_at(F.lit(values), F.col(column) + 1)


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64,
          pivots: int = 64, sample: int = 4096, group_queries: int = 8192, part_rows: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``is_query`` holds, the ``k`` largest inner products of
    floor(scale * vector) with the other rows; see the module's text."""
    spark = df.sparkSession
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 1e300 / scale))
    rows = df.where(fine).select(F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), F.col(vector).cast("array<double>").alias("vector"))
    id_type = rows.schema["id"].dataType
    out = StructType([StructField("query_id", id_type), StructField("rank", IntegerType()), StructField("vec_id", id_type), StructField("score", LongType())])
    least = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    n, dim, top = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(least)).first()
    if not n:
        return spark.createDataFrame([], out)
    top, slack = float(top), 1e-5 * (1 + float(top) ** 0.5)
    picked = floored(rows.orderBy(F.xxhash64("id", "vector")).limit(sample).select("vector").toArrow()["vector"].combine_chunks(), scale, dim)
    points = choose_pivots(np.column_stack([picked, lift(picked, top)]), pivots)

    def place(batches):
        for batch in batches:
            x = floored(batch["vector"], scale, dim)
            far, seen = distances(x, lift(x, top), points), distances(x, np.zeros(len(x)), points)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["is_query"], pa.array([r.tobytes() for r in x], pa.binary()), pa.array(far.argmin(1).astype(np.int32)),
                 pa.array(far.min(1)), pa.array(seen.argmin(1).astype(np.int32))], names=["id", "is_query", "vector", "cell", "dist", "query_cell"])

    placed = StructType([StructField("id", id_type), *StructType.fromDDL("is_query boolean, vector binary, cell int, dist double, query_cell int").fields])
    data = stored(rows.mapInArrow(place, placed).withColumn("row", F.monotonically_increasing_id()), "voronoi-rows")
    asked = data.where("is_query").groupBy("id", "vector", "query_cell").agg(F.count(F.lit(1)).alias("copies"))
    asked = stored(asked.withColumn("no", F.monotonically_increasing_id()), "voronoi-queries")

    in_cell = {r["cell"]: r["n"] for r in data.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {r["query_cell"]: r["n"] for r in asked.groupBy("query_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    chunks = [max(1, -(-in_cell.get(c, 0) // part_rows)) for c in range(len(points))]
    first, pieces, _ = pack_groups(wanted, points, group_queries)
    asked = asked.withColumn("group", (_pick(first, "query_cell") + F.pmod("no", _pick(pieces, "query_cell"))).cast("int"))

    def ring_rows(left, right):
        queries, known = unpack(left["vector"], dim), unpack(right["vector"], dim)
        enough = len(known) > k  # the query's own row may be among them
        kth = top_of(queries, known, k + 1)[1][:, -1].astype(np.float64) if enough else np.full(len(queries), -np.inf)
        low, high = rings(queries, kth, points, top, slack)
        groups = np.asarray(left["group"])
        got = [(g, c, low[groups == g, c].min(), high[(groups == g) & (low[:, c] <= high[:, c]), c].max(initial=-np.inf))
               for g in np.unique(groups) for c in range(len(points))]
        got = [r for r in got if r[2] <= r[3]]
        return pa.table([pa.array([r[i] for r in got], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64(), pa.float64()))],
                        names=["group", "cell", "low", "high"])

    by_chunk = data.select("cell", F.pmod(F.xxhash64("row"), _pick(chunks, "cell")).alias("chunk"), "vector")
    seeds = asked.select(F.col("query_cell").alias("cell"), F.pmod(F.xxhash64("no"), _pick(chunks, "query_cell")).alias("chunk"), "vector", "group")
    summary = seeds.groupBy("cell", "chunk").cogroup(by_chunk.groupBy("cell", "chunk")).applyInArrow(ring_rows, "group int, cell int, low double, high double")
    summary = stored(summary.groupBy("group", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high")), "voronoi-rings")

    parts = -(-n // part_rows)
    sent = data.join(summary, "cell").where("dist BETWEEN low AND high").select(
        "group", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), "id", "vector")
    meet = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))

    best = StructType([StructField("no", LongType()), StructField("query_id", id_type), StructField("copies", LongType()),
                       StructField("vec_id", id_type), StructField("score", LongType()), StructField("own", BooleanType())])
    kinds = rows.select("id").limit(0).toArrow().schema.field("id").type

    def solve(left, right):
        right = right.sort_by("id")  # nulls last
        places, scores = top_of(unpack(left["vector"], dim), unpack(right["vector"], dim), k + 1)
        each = places.shape[1]
        of = np.repeat(np.arange(left.num_rows), each)
        asked_rows, found = left.take(pa.array(of)), right["id"].take(pa.array(places.ravel()))
        selves = [int(sum(int(a) * int(a) for a in q)) for q in unpack(left["vector"], dim)]
        held = [min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in scores.ravel()]
        own = [a == b and s == selves[i] for a, b, s, i in zip(asked_rows["id"].to_pylist(), found.to_pylist(), scores.ravel(), of)]
        return pa.table([asked_rows["no"], asked_rows["id"], asked_rows["copies"], found.cast(kinds), pa.array(held, pa.int64()), pa.array(own, pa.bool_())],
                        names=["no", "query_id", "copies", "vec_id", "score", "own"])

    partial = meet.groupBy("group", "part").cogroup(sent.groupBy("group", "part")).applyInArrow(solve, best)
    ranked = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    merged = partial.withColumn("at", F.row_number().over(ranked)).where(F.col("at") <= k + 1)
    # One row among the best that equals the query is the query's own row.
    merged = merged.withColumn("self_at", F.min(F.when(F.col("own"), F.col("at"))).over(Window.partitionBy("no")))
    merged = merged.where(~F.coalesce(F.col("at") == F.col("self_at"), F.lit(False)))
    rank = (F.col("at") - F.coalesce((F.col("at") > F.col("self_at")).cast("int"), F.lit(0))).cast("int")
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(
        "query_id", "rank", "vec_id", "score")
