"""The metric index against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import neighbors as nb


def points(n, seed, dim=3):
    rng = random.Random(seed)
    blobs = [[rng.gauss(0, 8) for _ in range(dim)] for _ in range(7)]
    out = [(i, i % 3, [b + rng.gauss(0, 1) for b in blobs[0 if i % 2 else rng.randrange(7)]]) for i in range(n)]
    out += [(n + j, 0, list(out[j][2])) for j in range(5)]              # equal points
    return out + [(n + 10, 1, [1e4] * dim), (n + 11, 1, [0.0, None, 0.0]), (n + 12, 2, [float("nan")] * dim)]


def brute(rows, asked, k, other):
    fine = [r for r in rows if all(x is not None and math.isfinite(x) for x in r[2])]
    out = {}
    for i, t, v in fine:
        if i in asked:
            near = sorted((math.dist(v, w), j) for j, u, w in fine if j != i and (not other or u != t))[:k]
            for rank, (d, j) in enumerate(near, 1):
                out[i, rank] = (j, round(d, 9))
    return out


@pytest.mark.parametrize("cells,piece", [(None, 8192), (12, 8192), (40, 17), (1, 60)])
@pytest.mark.parametrize("other", [False, True])
def test_knn_equals_brute_force(spark, cells, piece, other):
    rows = points(300, 1)
    df = spark.createDataFrame(rows, "id long, tag int, v array<double>").repartition(5)
    index = nb.build_index(df, F.col("v"), ["id"], tag=F.col("tag") if other else None, cells=cells, sample=100, piece_rows=piece)
    asked = {r[0] for r in rows if r[0] % 4 == 0 or r[0] >= 295}
    got = nb.knn(index, df.where(F.col("id").isin(asked)), F.col("v"), 4, tag=F.col("tag") if other else None, piece_queries=piece)
    assert {(r["id"], r["rank"]): (r["nn_id"], round(r["distance"], 9)) for r in got.collect()} == brute(rows, asked, 4, other)


def test_fewer_points_than_k_and_no_points(spark):
    df = spark.createDataFrame([(1, 0, [0.0]), (2, 0, [3.0])], "id long, tag int, v array<double>")
    got = nb.knn(nb.build_index(df, F.col("v"), ["id"]), df, F.col("v"), 5).collect()
    assert sorted((r["id"], r["nn_id"], r["rank"], r["distance"]) for r in got) == [(1, 2, 1, 3.0), (2, 1, 1, 3.0)]
    alike = nb.build_index(df, F.col("v"), ["id"], tag=F.col("tag"))
    assert nb.knn(alike, df, F.col("v"), 1, tag=F.col("tag")).count() == 0
    none = df.limit(0)
    assert nb.knn(nb.build_index(none, F.col("v"), ["id"]), df, F.col("v"), 1).count() == 0


def test_far_cells_are_not_visited():
    """On separate blobs the bounds leave a query its own blob's cells."""
    data = np.array([r[2] for r in points(2000, 3) if None not in r[2] and r[2][0] == r[2][0]])
    pivots = nb.fit_pivots(data[:500], 30)
    far = nb.to_pivots(data, pivots)
    cell = far.argmin(1)
    held = np.unique(cell)
    least, most = (np.array([f(far[cell == c, c]) for c in held]) for f in (np.min, np.max))
    bound = nb.lower_bounds(data[:200], pivots, held, least, most)
    true = np.sqrt(((data[:200, None] - data[None]) ** 2).sum(2))
    for j, c in enumerate(held):
        assert (bound[:, j] <= true[:, cell == c].min(1) + 1e-9).all()
    kth = np.sort(true, 1)[:, 5]
    assert (bound <= kth[:, None]).mean() < 0.4


def test_boxes_exclude_units_that_spheres_do_not():
    """Points of one tag on either side of a plane through every cell: only their boxes tell them apart."""
    rng = np.random.default_rng(5)
    data = rng.normal(size=(4000, 4))
    data[:, 0] = np.where(data[:, 1] > 0, 1.0, 0.0)
    pivots = nb.fit_pivots(np.column_stack([np.full(500, 0.5), data[:500, 1:]]), 20)
    far = nb.to_pivots(data, pivots)
    cell, side = far.argmin(1), data[:, 0] == 1.0
    units = sorted({(c, s) for c, s in zip(cell.tolist(), side.tolist())})
    held = [(cell == c) & (side == s) for c, s in units]
    pivot_of = np.array([c for c, _ in units])
    least, most = (np.array([f(far[h, c]) for h, c in zip(held, pivot_of)]) for f in (np.min, np.max))
    asked = data[:200]
    spheres, boxes = nb.lower_bounds(asked, pivots, pivot_of, least, most), nb.box_bounds(asked, *(np.array([f(data[h], 0) for h in held]) for f in (np.min, np.max)))
    true = np.sqrt(((asked[:, None] - data[None]) ** 2).sum(2))
    for j, h in enumerate(held):
        assert (boxes[:, j] <= true[:, h].min(1)).all()
    kth = np.sort(true, 1)[:, 5]
    across = (pivot_of == cell[:200, None]) & (np.array([s for _, s in units]) != side[:200, None])
    near = across & (spheres <= kth[:, None])
    assert near.sum() > 20 and (boxes[near] > np.broadcast_to(kth[:, None], near.shape)[near]).all()


def test_visits_hold_few_bounds_at_a_time(spark, monkeypatch):
    """A batch's bounds to all units are worked out in slices."""
    df = spark.range(3000).select("id", F.array(F.rand(1), F.rand(2)).alias("v")).coalesce(1).checkpoint()
    index = nb.build_index(df, F.col("v"), ["id"], cells=30)
    plain = nb.lower_bounds

    def small(points, *rest):
        assert len(points) <= 512
        return plain(points, *rest)
    monkeypatch.setattr(nb, "lower_bounds", small)
    assert nb.knn(index, df, F.col("v"), 2).count() == 6000
