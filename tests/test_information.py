"""The nearest-neighbour estimate of mutual information against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import information as info


def psi(n):
    return sum(1 / i for i in range(1, n)) - info.EULER


def brute(rows, k):
    rows = [(x, y) for x, y in rows if x is not None and not math.isnan(x) and y is not None]
    rows = [r for r in rows if sum(r[1] == s[1] for s in rows) > 1]
    total = 0.0
    for i, (x, y) in enumerate(rows):
        own = sorted(abs(x - z) for j, (z, w) in enumerate(rows) if j != i and w == y)
        kth = min(k, len(own))
        r = own[kth - 1]
        m = sum(abs(x - z) < r or z == x for z, _ in rows)
        total += psi(kth) - psi(len(own) + 1) - psi(m)
    return max(0.0, psi(len(rows)) + total / len(rows)) if rows else None


def tables():
    rng = random.Random(2)
    smooth = [(rng.gauss(2 * (i % 3), 1), i % 3) for i in range(240)]
    grid = [(round(rng.uniform(0, 3), 1), rng.randrange(2)) for _ in range(300)]
    hot = [(1.0, 0)] * 150 + [(1.0, 1)] * 20 + [(rng.random(), 1) for _ in range(30)]
    odd = [(0.1 * i, i % 2) for i in range(40)] + [(None, 1), (float("nan"), 0), (3.0, None), (9.0, 5), (-0.0, 0), (0.0, 1), (1e300, 1), (-1e300, 0)]
    return {"smooth": smooth, "grid": grid, "hot": hot, "odd": odd, "two": [(1.0, 0), (2.0, 0), (1.5, 1)]}


@pytest.mark.parametrize("ranges", [1, 13])
def test_estimate_equals_brute_force(spark, ranges):
    for name, rows in tables().items():
        df = spark.createDataFrame(rows, "x double, t int").repartition(4)
        got = info.knn_mutual_information(df, "t", ["x"], num_partitions=ranges).collect()
        assert [(r["feature"], pytest.approx(r["mutual_info"], abs=1e-9)) for r in got] == [("x", brute(rows, 3))], name


def test_columns_apart_and_no_rows(spark):
    rows = [(float(i % 7), float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, t int")
    got = {r["feature"]: r["mutual_info"] for r in info.knn_mutual_information(df, "t", ["a", "b", "t"], k=2).collect()}
    assert got == {c: pytest.approx(brute([(r[i], r[2]) for r in rows], 2), abs=1e-9) for i, c in enumerate("ab")}
    assert info.knn_mutual_information(df.limit(0), "t", ["a"]).count() == 0


def test_digamma(spark):
    ns = [1, 2, 3, 9, 10, 11, 50, 1000]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in ns], "n bigint").select(info.digamma(F.col("n"))).collect()]
    assert got == [pytest.approx(psi(n), abs=1e-12) for n in ns]


def test_bounds_are_exact_to_the_last_bit():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=500), np.round(rng.normal(size=500), 1), rng.normal(size=100) * 1e9])
    r = np.abs(x - np.roll(x, 3))
    for sign in (-1, 1):
        at = info.nearer(x, r, sign)
        live = r > 0
        assert (np.abs(at - x) < r)[live].all() and (at == x)[~live].all()
        assert not (np.abs(np.nextafter(at, sign * np.inf) - x) < r)[live].any()
