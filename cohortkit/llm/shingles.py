"""Hashed words and word shingles of whole texts, shared by the passage and near-duplicate searches.

``hashed_words`` hashes all words of a slice of texts in numpy, eight bytes of every word at a
time; ``xxh_words`` then hashes each different word of the slice by xxh3.  Nothing is kept from slice to slice."""

from __future__ import annotations

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word that are hashed eight at a time; a longer word is hashed by itself.
LONG_WORD = 64
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: The first 0 to 8 bytes of a little-endian number.
FIRST_BYTES = np.array([256 ** n - 1 for n in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * MIX
        x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of one or more texts: (hashes, lower-cased bytes, each word's first byte and stop there, each text's first word and the last stop)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = LOWER[np.frombuffer(b" ".join([b"", *texts, b" " * 8]), np.uint8)]
    space = SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from each place on
    out = _mixed((stops - starts).astype(np.uint64))
    open_ = np.arange(len(starts))
    for done in range(0, LONG_WORD, 8):
        left = np.minimum(stops[open_] - starts[open_] - done, 8)
        out[open_] = _mixed(out[open_] ^ (eight[starts[open_] + done] & FIRST_BYTES[left]))
        open_ = open_[stops[open_] - starts[open_] > done + 8]
        if not len(open_):
            break
    for w in open_:
        out[w] = xxhash.xxh3_64_intdigest(raw[starts[w]:stops[w]])
    firsts = np.cumsum(sizes + 1) - sizes
    return out, raw, starts, stops, np.r_[np.searchsorted(starts, firsts), len(starts)]


def joined_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of the words (runs of bytes other than ASCII white space, A-Z lowered) of all texts in one array, and
    where in it each text begins and the last one stops.  Takes about 30 bytes a byte of the slice while it runs."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    out, *_, bounds = _words(texts)
    return out, bounds


def hashed_words(texts: list[bytes]) -> list[np.ndarray]:
    """``joined_words``, for each text an array."""
    if not texts:
        return []
    out, bounds = joined_words(texts)
    return np.split(out, bounds[1:-1])


def xxh_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``joined_words`` with the xxh3 hashes of the words; each different word of the slice is hashed in Python once."""
    if not texts:
        return joined_words(texts)
    out, raw, starts, stops, bounds = _words(texts)
    _, first, of = np.unique(out, return_index=True, return_inverse=True)
    data = raw.tobytes()
    hashes = [xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(starts[first].tolist(), stops[first].tolist())]
    return np.array(hashes, np.uint64)[of], bounds


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive hashed words; of fewer words, one of all of them."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    m = n - k + 1
    with np.errstate(over="ignore"):
        acc = np.full(m, np.uint64(k), np.uint64)
        for j in range(k):
            acc = (acc ^ words[j:j + m]) * MIX
            acc ^= acc >> np.uint64(29)
    return acc


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)
