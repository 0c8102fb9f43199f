import time

import numpy as np

from cohortkit.operators.tree_shap import Condition, Leaf, shapley_values, tables_of


def _forest(trees, depth, n, seed):
    rng, out = np.random.default_rng(seed), []

    def walk(conditions, left):
        if not left or rng.random() < 0.1:
            out.append(Leaf(float(rng.normal()), list(conditions.values())))
            return
        f, t, share = int(rng.integers(n)), round(float(rng.normal()), 1), float(rng.uniform(0.2, 0.8))
        for low in (True, False):
            had = conditions.get(f, Condition(f))
            now = Condition(f, had.share * (share if low else 1 - share), had.above, had.upto, list(had.bounded))
            if low:
                now.upto, now.bounded[1] = min(now.upto, t), True
            else:
                now.above, now.bounded[0] = max(now.above, t), True
            walk({**conditions, f: now}, left - 1)

    for _ in range(trees):
        walk({}, depth)
    return out


def _rows(n_rows, n, seed):
    x = np.random.default_rng(seed).normal(size=(n_rows, n)).round(1)
    x[::7, 0], x[1::9, n - 1], x[2::11, 1] = np.nan, np.inf, -np.inf
    return x


def test_tables_equal_the_formula_per_batch():
    for depth, n, patterns in ((4, 3, 256), (6, 8, 256), (6, 8, 8), (3, 5, 2), (12, 12, 256)):
        leaves, x = _forest(1 if depth > 6 else 4, depth, n, depth), _rows(300, n, 1)
        known = tables_of(leaves, n, patterns)
        assert np.allclose(known.values(x), shapley_values(x, leaves), atol=1e-12)
    assert tables_of(leaves, 12).rest  # long paths are left to the formula


def test_categories_stay_with_the_formula():
    leaves = [Leaf(1.0, [Condition(0, 0.4, sets=[(frozenset({1.0, 2.0}), True)])]), Leaf(-2.0, [Condition(0, 0.6, sets=[(frozenset({1.0, 2.0}), False)]), Condition(1, 0.5, upto=0.0, bounded=[False, True])])]
    x = np.array([[1.0, 0.0], [3.0, 1.0], [2.0, np.nan], [0.0, -1.0]])
    known = tables_of(leaves, 2)
    assert len(known.rest) == 2 and np.allclose(known.values(x), shapley_values(x, leaves))
    assert known.values(np.zeros((0, 2))).shape == (0, 2)


def test_tables_take_a_fraction_of_the_time():
    leaves, x = _forest(10, 6, 8, 5), _rows(8000, 8, 2)
    known = tables_of(leaves, 8)
    assert len(known.steps[0][0]) * 3 < len(leaves)  # several leaves a group
    begin = time.perf_counter()
    known.values(x)
    mid = time.perf_counter()
    shapley_values(x, leaves)
    assert mid - begin < (time.perf_counter() - mid) / 2
