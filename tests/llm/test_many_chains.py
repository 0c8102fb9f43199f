"""Seeds, chains and alignments of many texts in one go equal those of each, and their cost does not grow with the square."""

import random

import numpy as np
import xxhash

from cohortkit.llm import passages
from cohortkit.llm.shingles import xxh_words


def by_hand(parts, gap):
    """The chains of one pair: every earlier piece is tried."""
    worth, before = [], []
    for x, y, n in parts:
        value, tag = max(((worth[q] + (a + b) / (2 * gap), q) for q, (a, b, m) in enumerate(parts[:len(worth)])
                          if a < x and b < y and a + m >= x - gap and b + m >= y - gap), default=(float("-inf"), -1))
        gained = value - (x + y) / (2 * gap)
        worth.append(n + max(gained, 0))
        before.append(tag if gained > 0 else -1)
    out, used = [], set()
    for t in sorted(range(len(parts)), key=lambda t: -worth[t]):
        chain = []
        while t >= 0 and t not in used:
            used.add(t)
            chain.append(parts[t])
            t = before[t]
        out += [chain[::-1]] if chain else []
    return out


def test_chains_of_many_pairs_equal_those_of_each():
    rng = random.Random(3)
    for size in (0, 1, 2, 7, 60, 400):
        pairs = [sorted({(rng.randrange(9 * size + 9), rng.randrange(5 * size + 9)): rng.choice([8, 8, 9, 30, 200]) for _ in range(rng.randint(0, size))}.items()) for _ in range(5)]
        pairs = [[(x, y, n) for (x, y), n in p] for p in pairs]
        rows = np.array([(t, *p) for t, of in enumerate(pairs) for p in of], np.int64).reshape(-1, 4)
        alone, linked = passages.chains_of_pairs(*rows.T, 32)
        got = [[tuple(rows[t].tolist())] for t in alone.tolist()] + [[(t, *p) for p in c] for t, c in linked]
        assert sorted(got) == sorted([(t, *p) for p in c] for t, of in enumerate(pairs) for c in by_hand(of, 32))


def test_only_pieces_in_reach_go_through_the_tree(monkeypatch):
    rng = np.random.default_rng(6)
    for at_once in (passages.AT_ONCE, 50):
        monkeypatch.setattr(passages, "AT_ONCE", at_once)
        pair, x, y, n = np.unique(np.stack([rng.integers(0, 4, 600), rng.integers(0, 4000, 600), rng.integers(0, 900, 600), rng.choice([8, 9, 60], 600)]), axis=1)
        before = ((pair[:, None] == pair) & (x[:, None] < x) & (y[:, None] < y) & ((x + n)[:, None] >= x - 32) & ((y + n)[:, None] >= y - 32))
        assert passages.in_reach(pair, x, y, n, 32).tolist() == (before.any(0) | before.any(1)).tolist()
    called, chains = [], passages.chains
    monkeypatch.setattr(passages, "chains", lambda parts, gap: called.append(len(parts)) or chains(parts, gap))
    many = np.arange(20_000)  # a line that comes again and again, each time matched with its first place
    alone, linked = passages.chains_of_pairs(np.r_[0 * many, 1, 1], np.r_[12 * many, 0, 20], np.r_[0 * many, 0, 20], np.full(len(many) + 2, 8), 32)
    assert len(alone) == 20_000 and linked == [(1, [(0, 0, 8), (20, 20, 8)])] and called == [2]


def test_seeds_of_many_texts_equal_those_of_each():
    rng = random.Random(4)
    texts = [b" ".join(rng.choice([b"A", b"bc", b"d\xc3\xa9", b"E" * 70, b"x%d" % rng.randrange(50)]) for _ in range(n)) for n in (0, 3, 8, 12, 17, 18, 0, 300, 5, 900, 0)]
    hashes, bounds = xxh_words(texts)
    assert hashes.tolist() == [xxhash.xxh3_64_intdigest(w) for t in texts for w in t.lower().split()]
    text, s, at = passages.minimizers_of_texts(hashes, bounds, 8, 10)
    own = passages.own_places(s, at, 25, text)
    for t in range(len(texts)):
        each = passages.minimizers(hashes[bounds[t]:bounds[t + 1]], 8, 10)
        assert [c[text == t].tolist() for c in (s, at)] == [c.tolist() for c in each]
        for p, q, value in zip(at[text == t].tolist(), own[text == t].tolist(), s[text == t].tolist()):
            earlier = [b for b, v in zip(*(c[text == t].tolist() for c in (at, s))) if v == value and b <= p - 25]
            dense = any(v == value and p - 25 < b < p for b, v in zip(*(c[text == t].tolist() for c in (at, s))))
            assert q == (-1 if not earlier else earlier[-1] if dense else earlier[0])


def test_alignments_of_many_pieces_equal_those_of_each():
    rng = random.Random(5)
    texts = [np.array([rng.randrange(3) for _ in range(rng.choice([40, 90, 700]))], np.uint64) for _ in range(40)]
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    one = []
    for t in range(3000):
        i, j = rng.randrange(40), rng.randrange(40)
        x, y = rng.randrange(len(texts[i])), rng.randrange(len(texts[j]) + 1)
        one.append((i, j, x, y, rng.choice([1, 8, 20, 400])))
    i, j, x, y, n = np.array(one).T
    for margin in (64, 5, 0):
        flat = np.concatenate(texts)
        got = passages.aligned_pieces(flat, (bounds[i], bounds[i + 1]), flat, (bounds[j], bounds[j + 1]), x, y, n, margin)
        assert got.tolist() == [list(passages.align(texts[a], texts[b], 0, [(p, q, m)], margin)) for a, b, p, q, m in one]
