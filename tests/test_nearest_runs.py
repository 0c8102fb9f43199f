import numpy as np

from cohortkit.operators import neighbors


def test_nearest_by_runs_equal_all_distances(monkeypatch):
    rng = np.random.default_rng(4)
    for n, m, d, k in ((700, 50, 3, 1), (5000, 40, 8, 6), (130, 9, 2, 6), (5, 4, 2, 6), (900, 30, 2, 5)):
        points, queries = rng.normal(size=(n, d)).round(1 if d == 2 else 6), rng.normal(size=(m, d)).round(1 if d == 2 else 6)
        points[: n // 4] = points[n // 4: n // 4 * 2][: n // 4]  # equal points: the earlier one comes first
        of, to, dist = neighbors.nearest_of(queries, points, k)
        full = np.sqrt(((queries[:, None] - points) ** 2).sum(2))
        order = np.lexsort((np.broadcast_to(np.arange(n), full.shape), full), axis=1)[:, :k]
        assert of.tolist() == np.repeat(np.arange(m), min(k, n)).tolist() and to.tolist() == order.ravel().tolist()
        # Within the known k-th distance nothing is missed.
        kth = np.take_along_axis(full, order, 1)[:, -1] * np.where(np.arange(m) % 2, 1.0, 0.5)
        a, b, c = neighbors.nearest_of(queries, points, k, kth)
        got = {(i, j) for i, j, x in zip(a, b, c) if x <= kth[i]}
        assert got == {(i, j) for i, j, x in zip(of, to, dist) if x <= kth[i]}
    assert [len(x) for x in neighbors.nearest_of(queries, points + 100, k, np.zeros(m))] == [0, 0, 0]


def test_few_of_the_distances_are_partitioned(monkeypatch):
    seen, real = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *r: seen.append(a.size) or real(a, *r))
    rng = np.random.default_rng(1)
    neighbors.nearest_of(rng.normal(size=(64, 8)), rng.normal(size=(8192, 8)), 6)
    assert sum(seen) <= 64 * 8192 / 32
