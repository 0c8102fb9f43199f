"""The Voronoi kNN join against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import voronoi

INF, NAN = float("inf"), float("nan")


def brute(rows, is_query, k, scale):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, q) in enumerate(fine):
        if i is None or not is_query(i):
            continue
        score = [(-sum(x * y for x, y in zip(q, v)), j is None, j if j is not None else 0, j) for b, (j, v) in enumerate(fine) if b != a]
        for rank, (s, _, _, j) in enumerate(sorted(score, key=lambda t: t[:3])[:k], 1):
            out[i, rank, j, -s] += 1
    return out


def got(df):
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def clustered(n, dim, seed):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.03) for c in centers[0 if i % 3 == 0 else rng.randrange(6)]]) for i in range(n)]


@pytest.mark.parametrize("size", [(4, 8192, 8192), (16, 10, 40), (64, 3, 1000)])
def test_top_k_equals_brute_force(spark, size):
    rows = clustered(400, 5, 1)
    rows += [(20, rows[20][1]), (20, rows[20][1]), (None, rows[40][1]), (None, [0.5] * 5), (1000, None), (1001, [NAN] * 5), (1002, [1.0, None, 0.0, 0.0, 0.0]),
             (1003, [INF, 0.0, 0.0, 0.0, 0.0]), (1004, [2.0, 1.0]), (1005, []), (1010, [-0.001] * 5), (60, [0.1] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select(
        "*", *[F.lit(7).alias(c) for c in ("Score", "cell", "rank", "is_query", "vector", "id", "group")])
    pivots, group, part = size
    out = voronoi.top_k(df, F.col("vec_id") % 10 == 0, k=7, pivots=pivots, sample=100, group_queries=group, part_rows=part)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(out) == brute(rows, lambda i: i % 10 == 0, 7, 64)


def test_fewer_rows_than_k_ties_and_empty(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (20, [0.0, 1.0])]
    out = voronoi.top_k(spark.createDataFrame(few, schema), F.col("vec_id") % 20 == 0)
    assert got(out) == brute(few, lambda i: i % 20 == 0, 20, 64)
    assert voronoi.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert voronoi.top_k(spark.createDataFrame([(0, None)], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert voronoi.top_k(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_products_too_large_for_doubles_are_exact():
    q, d = np.array([[2.0 ** 40, 3.0]]), np.array([[2.0 ** 20, 1.0], [2.0 ** 20, 2.0], [2.0 ** 20, 2.0]])
    places, scores = voronoi.top_of(q, d, 2)
    assert places.tolist() == [[1, 2]] and [int(s) for s in scores[0]] == [2 ** 60 + 6] * 2


def test_rings_hold_every_answer_and_exclude_far_cells():
    data = np.array([v for _, v in clustered(600, 5, 2)])
    data = np.floor(64 * data)
    top = (data ** 2).sum(1).max()
    full = np.column_stack([data, voronoi.lift(data, top)])
    pivots = voronoi.choose_pivots(full[:80], 12)
    far = voronoi.distances(data, full[:, -1], pivots)
    cell, dist = far.argmin(1), far.min(1)
    queries = data[::50]
    scores = queries @ data.T
    kth = np.sort(scores, 1)[:, -8]
    low, high = voronoi.rings(queries, kth, pivots, top, 1e-3)
    inside = (low[:, cell] <= dist) & (dist <= high[:, cell])
    assert inside[scores >= kth[:, None]].all()
    assert inside.mean() < 0.7


def test_groups_hold_every_query_cell_and_bound_their_size():
    pivots = np.random.default_rng(0).normal(size=(20, 3))
    counts = {i: 7 * i for i in range(20)}
    first, pieces, n = voronoi.pack_groups(counts, pivots, 50)
    load = Counter()
    for c in range(20):
        for p in range(pieces[c]):
            load[first[c] + p] += counts[c] / pieces[c]
    assert max(load) < n and max(load.values()) <= 50
    assert all(pieces[c] == -(-counts[c] // 50) for c in range(20) if counts[c] > 50)
