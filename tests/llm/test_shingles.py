"""Hashed words against words split and lowered one at a time."""

import random

import numpy as np

from cohortkit.llm.shingles import LONG_WORD, hashed_words


def test_equal_hashes_are_equal_words():
    rng = random.Random(3)
    alphabet = [b"a", b"A", b"b", b"\x00", b" ", b"\t", b"\x0b", "é".encode(), " ".encode(), b"0"]
    texts = [b"".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += [b"", b" ", b"x" * 500_000, b"X" * 500_000 + b" y", b"q" * LONG_WORD, b"q" * (LONG_WORD + 1), b"abcdefgh", b"ABCDEFGHi abcdefg", b""]
    texts += [b" ".join(b"%d" % i for i in range(5000))]
    got = hashed_words(texts)
    assert len(got) == len(texts) and all(h.dtype == np.uint64 for h in got)
    word_of, hash_of = {}, {}
    for text, hashes in zip(texts, got):
        words = text.lower().split()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist()):
            assert word_of.setdefault(h, w) == w and hash_of.setdefault(w, h) == h
    assert [h.tolist() for t in texts for h in hashed_words([t])] == [h.tolist() for h in got]  # whatever the slice


def test_no_texts():
    assert hashed_words([]) == [] and [len(h) for h in hashed_words([b"", b"\n"])] == [0, 0]
