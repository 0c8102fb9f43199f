"""What an explanation shares is worked out once, and a batch at a time."""
import numpy as np

from cohortkit.functions import keyed
from cohortkit.operators import interpret as xp, ml, tree_scores


def test_comparison_works_out_each_ranking_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", None)]
    a = spark.createDataFrame(rows, "feature string, importance double").coalesce(1).mapInArrow(counted, "feature string, importance double")
    b = spark.createDataFrame([("a", 1.0), ("b", 0.5), ("c", 0.1), ("d", 0.0)], "feature string, importance double")
    got = xp.compare_explanations(a, b).first()
    assert seen.value == len(rows)
    assert got["n_features"] == 3 and round(got["spearman"], 6) == 0.866025


def test_permutation_importance_finds_donors_in_batches(spark, monkeypatch):
    monkeypatch.setattr(keyed, "permuted_index", lambda *a: 1 / 0)  # an expression walked in every row
    df = spark.createDataFrame([(i, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(60)], "id long, a double, b double, label int")
    got = {r["feature"]: r["importance_mean"] for r in xp.permutation_importance(ml.LinearScorer({"a": 1.0, "b": 0.0}, -2.5), df, ["a", "b"], repeats=4).collect()}
    assert got["b"] == 0.0 and got["a"] > 0.2


def test_numbers_of_a_batch_go_where_each_goes():
    for n in (1, 2, 3, 10, 1000, 1001):
        for r in range(3):
            keys = [of[r] for of in keyed.lines_of(7, 3)]
            got = keyed.permuted_numbers(np.arange(n), n, keys)
            assert got.tolist() == [keyed.permuted_number(i, n, keys) for i in range(n)]


def test_votes_of_any_open_leaf():
    shares = np.random.default_rng(0).random((3, 64, 2))
    forest = tree_scores.Forest([], [], shares)
    left = np.array([[1 << i | (1 << 63 if i % 2 else 0) for i in range(64)]] * 3, np.uint64)
    zero, one = forest.votes(left)
    for i in range(64):
        assert [zero[i], one[i]] == (shares[0, i] + shares[1, i] + shares[2, i]).tolist()
