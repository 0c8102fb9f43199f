"""Keyed pseudo-random numbers and permutations in plain whole-number arithmetic, the same in Spark, numpy and SQL.

``mix`` maps a number below 2^31 to one below ``PRIME`` = 2^31 - 1 by a keyed line and a square.
``permuted_index`` is a bijection of 0..n-1: a Feistel network over pairs (l, r) of a grid of a x b >= n cells,
with results outside 0..n-1 walked on until they fall inside.  At most a - 1 cells are outside, so a walk is of length 1 but
for about one index in the root of n.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# ``permuted_numbers`` goes to executors by value, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = 2_147_483_647
ROUNDS = 4
#: Walks of more steps than this do not occur: the chance of one is below n^(-WALK / 2).
WALK = 64


def line(*parts) -> tuple[int, int]:
    """The factor and the addend that a key stands for."""
    raw = hashlib.md5("|".join(map(str, parts)).encode()).digest()
    return int.from_bytes(raw[:8], "big") % (PRIME - 1) + 1, int.from_bytes(raw[8:], "big") % PRIME


def mix(x, factor, addend):
    """Works on numbers and on columns."""
    y = (x * factor + addend) % PRIME
    return y * y % PRIME


def grid(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-n // a) or 1


def lines_of(seed: int, repeats: int) -> list[list[tuple[int, int]]]:
    """Per round, one line per repeat."""
    return [[line(seed, repeat, r) for repeat in range(repeats)] for r in range(ROUNDS)]


def _network(x, n: int, keys: Sequence):
    a, b = grid(n)
    l, r = F.floor(x / F.lit(b)).cast("bigint") if isinstance(x, Column) else x // b, x % b
    for i, (factor, addend) in enumerate(keys):
        if i % 2 == 0:
            l = (l + mix(r, factor, addend)) % a
        else:
            r = (r + mix(l, factor, addend)) % b
    return l * b + r


def permuted_number(x: int, n: int, keys: Sequence[tuple[int, int]]) -> int:
    x = _network(x, n, keys)
    while x >= n:
        x = _network(x, n, keys)
    return x


def permuted_numbers(x: np.ndarray, n: int, keys: Sequence[tuple[int, int]]) -> np.ndarray:
    """Where whole numbers of 0..n-1 go, a batch at a time."""
    x = _network(x.astype(np.int64), n, keys)
    while len(out := np.nonzero(x >= n)[0]):
        x[out] = _network(x[out], n, keys)
    return x


def permuted_index(index: Column, n: int, repeat: Column, lines: list[list[tuple[int, int]]]) -> Column:
    """Where ``index`` (0..n-1) goes in the permutation of ``repeat``."""
    pick = lambda values: F.element_at(F.lit(values), (repeat + 1).cast("int")).cast("bigint")
    keys = [(pick([f for f, _ in of]), pick([c for _, c in of])) for of in lines]
    first = _network(index.cast("bigint"), n, keys)
    steps = F.sequence(F.lit(1), F.lit(min(WALK, grid(n)[0])))
    return F.aggregate(steps, first, lambda x, _: F.when(x < n, x).otherwise(_network(x, n, keys)))
