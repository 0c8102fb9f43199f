"""Language ID with error-correcting output codes.

Each language has a codeword of bits; one linear classifier per bit reads the
hashed character n-grams (two to four bytes of the lower-case text) of a whole
text.  Decoding adds up, for each language, the logistic loss of all bits
against its codeword, each bit weighted by how well it did on a part of the
sample kept for that, and takes the least.  The margin to the second flags
ambiguous texts.

Training takes a bounded sample: about ``per_language`` labelled texts of each
language, chosen by a hash of id and text; their feature rows (``DIM`` floats)
are all that reaches the driver.  Prediction is one pass with a broadcast
matrix of ``DIM`` x bits; texts are read whole, in pieces, and never shuffled.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
single training language is predicted for every other text; with no training rows
every text is ``und``; repeated rows and extra columns are kept;
columns with the names of the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shipped, plus, text_slices, without

#: Hashed n-gram counts of a text; multipliers of the hash.
DIM = 4096
PIECE = 1 << 20
UND = "und"
#: ASCII other than letters, as spaces: figures and marks say little of a language.
PLAIN = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode category L; figures like ½ or ² are none)."""
    return any(map(str.isalpha, text))


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams: a vector of length 1."""
    data = b" " + text.decode("utf-8", "replace").lower().encode().translate(PLAIN) + b" "
    total = np.zeros(DIM, np.int64)
    for begin in range(0, len(data), PIECE):
        a = np.frombuffer(data, np.uint8, min(PIECE + 3, len(data) - begin), begin).astype(np.uint32)
        two = a[:-1] * np.uint32(257) + a[1:]
        grams = [two[:PIECE]]
        if len(a) > 2:
            three = two[:-1] * np.uint32(263) + a[2:]
            grams.append(three[:PIECE])
            if len(a) > 3:
                grams.append((three[:-1] * np.uint32(269) + a[3:])[:PIECE])
        for n, g in enumerate(grams):
            total += np.bincount(((g + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    return np.sqrt(total / max(1, total.sum())).astype(np.float32)


def code_matrix(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of +1 and -1: every split of the languages for up to 6 of them, else the
    random matrix of 15 log2(n) bits with the largest least distance of 200."""
    if n <= 6:
        return np.array([[1 if c == 0 or not (b >> (c - 1)) & 1 else -1 for b in range(1, 2 ** (n - 1))] for c in range(n)], np.float32).reshape(n, -1)
    rng, best, width = np.random.default_rng(seed), (-1, None), int(np.ceil(15 * np.log2(n)))
    for _ in range(200):
        m = rng.choice(np.array([-1, 1], np.float32), (n, width))
        m = m[:, np.abs(m.sum(0)) < n]
        distance = int(((m[:, None] != m[None]).sum(2) + np.eye(n, dtype=int) * width).min())
        if distance > best[0]:
            best = (distance, m)
    return best[1]


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.weights, self.bias, self.trust = langs, code, weights, bias, trust

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted loss of every language (columns) for every row."""
        margins = x @ self.weights + self.bias
        return np.stack([np.logaddexp(0, -margins * c) @ self.trust for c in self.code], 1)


def _fit_bits(x: np.ndarray, y: np.ndarray, code: np.ndarray, rounds: int, penalty: float = 1e-4):
    """All bit classifiers at once: logistic loss, Nesterov's accelerated descent; each language weighs the same."""
    target = code[y]
    share = 1 / np.bincount(y, minlength=len(code))[y]
    share = (share / share.sum()).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead_w, ahead_b = w, b
    for k in range(rounds):
        slope = -target * share / (1 + np.exp(np.clip(target * (x @ ahead_w + ahead_b), -30, 30)))
        new_w, new_b = ahead_w - 4 * (x.T @ slope + penalty * ahead_w), ahead_b - 4 * slope.sum(0)
        ahead_w, ahead_b = new_w + k / (k + 3) * (new_w - w), new_b + k / (k + 3) * (new_b - b)
        w, b = new_w, new_b
    return w, b


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 400, rounds: int = 150) -> Model:
    """A model from about ``per_language`` rows of each non-null language of ``rows``."""
    known = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, 0), np.float32), np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32), np.zeros(0))
    scale = 1 << 30
    cutoff = F.coalesce(*[F.when(F.col("lang") == c, F.lit(min(scale, int(scale * per_language / n) + 1))) for c, n in counts.items()])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(scale))

    def vectors(batches):
        for batch in batches:
            for begin, texts in text_slices(batch.column(0)):
                part = [features(t).tobytes() for t in texts]
                yield pa.record_batch({"lang": batch.column(1).slice(begin, len(texts)), "draw": batch.column(2).slice(begin, len(texts)),
                                       "x": pa.array(part, pa.binary())})

    sample = known.withColumn("draw", draw).filter(F.col("draw") < cutoff).select("text", "lang", "draw")
    got = sample.mapInArrow(vectors, "lang string, draw bigint, x binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["draw"], r["lang"], r["x"]))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    y = np.array([langs.index(r["lang"]) for r in got])
    code = code_matrix(len(langs))
    if len(langs) == 1:
        return Model(langs, np.zeros((1, 0), np.float32), np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32), np.zeros(0))
    kept = np.arange(len(y)) % 5 == 4
    if len(set(y[~kept])) < len(langs):
        kept[:] = False
    w, b = _fit_bits(x[~kept], y[~kept], code, rounds)
    trust = np.ones(code.shape[1])
    if kept.any():
        right = ((x[kept] @ w + b) * code[y[kept]] > 0).mean(0)
        trust = np.clip(2 * right - 1, 0.05, 1)
        w, b = _fit_bits(x, y, code, rounds)
    return Model(langs, code, w, b, trust / trust.sum() * len(trust))


def predict(docs: DataFrame, model: Model, text_col: str = "text", ambiguous_margin: float = 0.1) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the share of the best language in a softmax of
    the negative losses) and ``ambiguous`` (best and second differ by less than ``ambiguous_margin``)."""
    docs = without(docs, "lang_pred", "score", "ambiguous")
    at = docs.columns.index(text_col)
    shipped = Shipped(docs.sparkSession, model)

    def run(batches):
        own = shipped.get()
        for batch in batches:
            for begin, texts in text_slices(batch.column(at)):
                lang, score, unclear = [UND] * len(texts), [0.0] * len(texts), [False] * len(texts)
                lettered = [i for i, t in enumerate(texts) if has_letter(t.decode("utf-8", "replace"))] if own.langs else []
                if lettered and len(own.langs) == 1:
                    for i in lettered:
                        lang[i], score[i] = own.langs[0], 1.0
                else:
                    for k in range(0, len(lettered), 256):
                        some = lettered[k:k + 256]
                        shares = -own.losses(np.stack([features(texts[i]) for i in some]))
                        shares = np.exp(shares - shares.max(1, keepdims=True))
                        shares /= shares.sum(1, keepdims=True)
                        best = shares.argmax(1)
                        second = np.sort(shares, 1)[:, -2]
                        for i, c, row, next_best in zip(some, best, shares, second):
                            lang[i], score[i], unclear[i] = own.langs[c], float(row[c]), bool(row[c] - next_best < ambiguous_margin)
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unclear, pa.bool_())],
                                                 names=[*part.schema.names, "lang_pred", "score", "ambiguous"])

    return docs.mapInArrow(run, plus(docs.schema, "lang_pred string, score double, ambiguous boolean"))
