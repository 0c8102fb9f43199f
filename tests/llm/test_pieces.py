"""The pieces of many pairs of texts in one go."""

import random

import numpy as np

from cohortkit.llm import passages


def by_hand(matches, k, reach):
    """One pair's pieces, match by match."""
    out = []
    for d in sorted({y - x for x, y in matches}):
        for x in sorted({x for x, y in matches if y - x == d}):
            if out and out[-1][3] == d and x - out[-1][2] <= reach:
                out[-1][2] = x
            else:
                out.append([x, x + d, x, d])
    return sorted((x, y, last + k - x) for x, y, last, _ in out)


def test_pieces_of_many_pairs_equal_those_of_each():
    rng = random.Random(5)
    for m in [0, 1, *range(2, 200, 7)]:
        rows = np.array([(rng.randrange(5), rng.randrange(60), rng.randrange(40)) for _ in range(m)], np.int64).reshape(-1, 3)
        got = list(zip(*(c.tolist() for c in passages.pieces_of_pairs(*rows.T, 8, 12))))
        assert got == [(p, *t) for p in sorted({r[0] for r in rows.tolist()}) for t in by_hand([r[1:] for r in rows.tolist() if r[0] == p], 8, 12)]
