"""Toxicity from a learned lexicon, fuzzy matching and context windows.

1. Lexicon: words, and stems of at least ``STEM`` letters, whose share among toxic
   training texts far exceeds that among others, in a trie.  All of ``SHORTEST`` letters or more that
   reach the least share and lift are taken; since each is in at least 0.4 % of the toxic texts learnt from, they are at
   most 250 times the distinct words and stems of an average one.
2. Matching: every term is a Levenshtein automaton (one edit from ``EDIT1`` letters, two from
   ``EDIT2``); walking the trie under all of them at once is the intersection.  Its
   states are sets of (trie node, edits), made when first met, so a word costs one look-up a letter.  A stem also takes any ending.
   Words with figures or marks inside ("mor0n", "st*pid", "m_o_r_o_n") are matched whole, and without these, as misspelled ones.
3. Context: a hit counts by the words and marks around it: less within quotation marks or
   near a word of reporting, more near a word of address.
4. A logistic model of the summed, weighted hits gives the score.

Training takes at most about ``per_class`` labelled texts of each class, chosen by a hash of the id; the ids of the
sample are broadcast; of the texts only the sample's are shuffled, to learn from equal ones once.  Scoring is one pass over whole texts.

Defined cases: null and empty texts get the score of a text without hits; several labels of one id count as
toxic if one is; labels without a text, and null labels, are ignored; without training rows of both classes every
score is the share of toxic rows (0 without rows); repeated rows and extra columns are kept; columns with
the names of the added ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shipped, plus, stored, text_slices, without

STEM, EDIT1, EDIT2 = 5, 4, 9
#: Shorter words (and quotation marks) are no terms: they are mostly pronouns and articles.
SHORTEST = 3
FLUSH = 200_000
CACHE_WORDS = 300_000
CACHE_STATES = 100_000
#: Longer words are matched each time they occur, and not kept.
KEPT = 80
TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
#: Letters with figures or marks between or before them: a word that may be disguised.
ODD = re.compile(r"(?<![^\W_])[@$]?[^\W\d_]*(?:[\d_*@$#!+|.'’\-]+[^\W\d_]+)+\$*")
SIGNS, FIGURES, DISGUISES = re.compile(r"[_*@$#!+|.'’\-]+"), re.compile(r"\d+"), re.compile(r"[\d_*@$#!+|]")
MARKS = frozenset("\"“”«»„")
WINDOW = 8
#: Words of reporting and of address, in the languages of the texts we know.
REPORTING = frozenset("said says wrote quoted quote called calls reported according sagte sagt schrieb zitat zitierte dit écrit citation cité selon dijo dice escribió cita según".split())
ADDRESS = frozenset("you your you're youre u du dich dir dein ihr euch tu toi te ton vous votre tú ti vos usted ustedes".split())
QUOTED, REPORTED, ADDRESSED = 0.35, 0.6, 1.25


def words_of(text: bytes) -> list[str]:
    """Words and quotation marks of the lower-case text."""
    return TOKEN.findall(text.decode("utf-8", "replace").lower())


class Lexicon:
    """Terms as (string, is a stem, weight) and the automaton over all of them."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms
        self.children: list[dict] = [{}]
        self.ends: list[list[int]] = [[]]
        self.room = [0]
        for t, (term, _, _) in enumerate(terms):
            node, edits = 0, 2 if len(term) >= EDIT2 else 1 if len(term) >= EDIT1 else 0
            for c in [*term, None]:
                self.room[node] = max(self.room[node], edits)
                if c is None:
                    self.ends[node].append(t)
                elif c in self.children[node]:
                    node = self.children[node][c]
                else:
                    self.children[node][c] = node = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.room.append(0)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict = {}
        self.states: list = []
        self.moves: list[dict] = []
        self.accepted: list = []
        self.stems: list = []
        self.start = self._state({(0, 0)})

    def _allowed(self, t: int) -> int:
        n = len(self.terms[t][0])
        return 2 if n >= EDIT2 else 1 if n >= EDIT1 else 0

    def _state(self, pairs: set) -> int:
        """The number of a set of (node, edits), closed under leaving out letters of a term."""
        best: dict[int, int] = {}
        todo = sorted(pairs, key=lambda p: p[1])
        while todo:
            node, e = todo.pop()
            if e > self.room[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            todo += [(child, e + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        if not key:
            return -1
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            found = [(e, t) for node, e in key for t in self.ends[node] if e <= self._allowed(t)]
            self.accepted.append(min((f for f in found), default=None))
            self.stems.append(min((f for f in found if self.terms[f[1]][1]), default=None))
        return self.numbers[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.states[state]:
            out.add((node, e + 1))
            for letter, child in self.children[node].items():
                out.add((child, e if letter == c else e + 1))
        self.moves[state][c] = to = self._state(out)
        return to

    def match(self, word: str):
        """(edits, term) of the nearest term, or None.  A stem accepts the rest of the word."""
        if len(self.states) > CACHE_STATES:
            self._reset()
        s, stem = self.start, None
        for c in word:
            to = self.moves[s].get(c)
            s = self._move(s, c) if to is None else to
            if s < 0:
                return stem
            if self.stems[s] is not None and (stem is None or self.stems[s] < stem):
                stem = self.stems[s]
        found = [x for x in (stem, self.accepted[s]) if x is not None]
        return min(found, default=None)


class Matcher:
    """Features of a text: hits weighted by term and context."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.seen, self.hits = lexicon, set(), {}

    def _odd(self, word: str):
        """(edits, term) nearest to a word with figures or marks inside: as it is, without its marks, or with letters alone.
        None if one of its runs of letters has a hit of its own, or if whole words are joined by stops or hyphens."""
        parts = TOKEN.findall(word)
        if not (DISGUISES.search(word) or min(map(len, parts)) <= 2) or any(self.lexicon.match(w) for w in parts):
            return None
        plain = SIGNS.sub("", word)
        found = [m for m in map(self.lexicon.match, {word, plain, FIGURES.sub("", plain)}) if m is not None]
        return min(((max(1, edits), t) for edits, t in found), default=None)

    def _words(self, text: bytes) -> list[str]:
        """The words of a text, a disguised one with a hit in one piece."""
        low = text.decode("utf-8", "replace").lower()
        odd = set(ODD.findall(low))
        for w in odd - self.seen:
            m = self._odd(w)
            if m is not None:
                self.hits[w] = m
        self.seen.update(w for w in odd if len(w) <= KEPT)
        if self.hits.keys().isdisjoint(odd):
            return TOKEN.findall(low)
        out, at = [], 0
        for m in ODD.finditer(low):
            if m.group() in self.hits:
                out += [*TOKEN.findall(low, at, m.start()), m.group()]
                at = m.end()
        return out + TOKEN.findall(low, at)

    def features(self, text: bytes) -> list[float]:
        if len(self.seen) > CACHE_WORDS:
            self.seen, self.hits = set(), {}
        words = self._words(text)
        distinct = set(words)
        for w in distinct - self.seen:
            m = self.lexicon.match(w)
            if m is not None:
                self.hits[w] = m
        self.seen.update(w for w in distinct if len(w) <= KEPT)
        exact = near = most = quoted = 0.0
        if not self.hits.keys().isdisjoint(distinct):
            inside = False
            for i, w in enumerate(words):
                if w in MARKS:
                    inside = not inside
                elif w in self.hits:
                    edits, t = self.hits[w]
                    around = {*words[max(0, i - WINDOW):i], *words[i + 1:i + 1 + WINDOW]}
                    value = self.lexicon.terms[t][2]
                    if inside and not MARKS.isdisjoint(words[i + 1:i + 1 + 4 * WINDOW]):
                        value, quoted = value * QUOTED, quoted + 1
                    if not REPORTING.isdisjoint(around):
                        value *= REPORTED
                    if not ADDRESS.isdisjoint(around):
                        value *= ADDRESSED
                    if edits:
                        near += value
                    else:
                        exact += value
                        most = max(most, value)
        n = len(words)
        return [np.log1p(exact), np.log1p(near), most, np.log1p(100 * exact / (n + 10)), np.log1p(100 * near / (n + 10)), np.log1p(n) / 10]


N_FEATURES = 6


class Model:
    def __init__(self, terms, weights, bias):
        self.terms, self.weights, self.bias = terms, weights, bias


def _prefixes(words: set[str]):
    """Whole words (marked by a final space) and stems of a text."""
    out = set()
    for w in words:
        if len(w) < SHORTEST:
            continue
        out.add(w + " ")
        out.update(w[:n] for n in range(STEM, min(len(w), STEM + 4)))
    return out


def _text_counts(rows: DataFrame) -> DataFrame:
    """``term, n``: texts of ``rows`` with each whole word or stem."""

    def count(batches):
        have: Counter = Counter()
        out = lambda: pa.record_batch({"term": pa.array(list(have), pa.string()), "n": pa.array(list(have.values()), pa.int64())})
        long = 0
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                for t in texts:
                    words = set(words_of(t))
                    have.update(_prefixes(words))
                    long += sum(len(w) for w in words if len(w) > KEPT)
                    if len(have) > FLUSH or long > FLUSH * KEPT:
                        yield out()
                        have.clear()
                        long = 0
        yield out()

    return rows.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def learn_terms(rows: DataFrame, n_toxic: int, n_other: int, least_lift: float = 12.0) -> list[tuple[str, bool, float]]:
    """Words and stems at least ``least_lift`` times as frequent among toxic texts; of nested ones the
    shortest that gains texts.  Weights are logarithms of the lift, largest 1."""
    support = max(4, int(0.004 * n_toxic))
    toxic = _text_counts(rows.filter("toxic = 1")).filter(F.col("n") >= support)
    other = _text_counts(rows.filter("toxic = 0")).withColumnRenamed("n", "n_other")
    ratio = ((F.col("n") + 0.5) / (n_toxic + 1)) / ((F.coalesce("n_other", F.lit(0)) + 1) / (n_other + 1))
    found = toxic.join(other, "term", "left").select("term", "n", ratio.alias("lift")).filter(F.col("lift") >= least_lift).collect()
    lift, texts = {r["term"]: r["lift"] for r in found}, {r["term"]: r["n"] for r in found}
    most: dict[str, int] = {}  # texts of the most frequent word of each stem
    for t in texts:
        if t.endswith(" "):
            for n in range(STEM, min(len(t), STEM + 4)):
                most[t[:n]] = max(most.get(t[:n], 0), texts[t])
    chosen: dict[str, None] = {}
    for t in sorted(texts, key=lambda t: (-texts[t], t)):  # a stem comes before all longer terms
        if any(t[:n] in chosen for n in range(STEM, min(len(t), STEM + 4))):
            continue  # a chosen stem has all its texts
        if not t.endswith(" "):
            if texts[t] < 1.25 * most.get(t, 0):
                continue  # little more than one word
            chosen.pop(t + " ", None)
        chosen[t] = None
    top = max((np.log(lift[t]) for t in chosen), default=1.0)
    return [(t.strip(), not t.endswith(" "), float(np.log(lift[t]) / top)) for t in chosen]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method with a ridge."""
    z = np.c_[x, np.ones(len(x))]
    beta, weight = np.zeros(z.shape[1]), weight / weight.sum()
    ridge = np.eye(z.shape[1]) * penalty
    ridge[-1, -1] = 1e-9
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ beta
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta - step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return beta[:-1], float(beta[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 15_000) -> Model:
    """A model from the texts of ``docs`` that ``labels`` marks."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    scale = 1 << 30
    cutoff = F.when(F.col("toxic") == 1, F.lit(min(scale, int(scale * per_class / max(1, n.get(1, 0))) + 1))).otherwise(
        F.lit(min(scale, int(scale * per_class / max(1, n.get(0, 0))) + 1)))
    sample = marked.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < cutoff)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("text", "toxic")  # about 2 x per_class ids
    rows = stored(rows.groupBy(F.sha2("text", 256).alias("digest"), "text").agg(F.max("toxic").alias("toxic")).drop("digest"), "toxicity-sample")
    have = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not have.get(0) or not have.get(1):
        share = have.get(1, 0) / max(1, sum(have.values()))
        return Model([], np.zeros(N_FEATURES), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    terms = learn_terms(rows, have[1], have[0])
    lexicon = Shipped(docs.sparkSession, terms)

    def featured(batches):
        matcher = Matcher(Lexicon(lexicon.get()))
        for batch in batches:
            for begin, part in text_slices(batch.column(0)):
                x = [matcher.features(t) for t in part]
                yield pa.record_batch({"toxic": batch.column(1).slice(begin, len(part)), "x": pa.array(x, pa.list_(pa.float64()))})

    got = rows.mapInArrow(featured, "toxic int, x array<double>").toArrow()
    y = got["toxic"].to_numpy().astype(float)
    x = np.array(got["x"].to_pylist())
    of_class = np.where(y == 1, n[1] / have[1], n[0] / have[0])  # the sample's classes back to their shares
    weights, bias = _fit(x, y, of_class)
    return Model(terms, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``)."""
    docs = without(docs, "score", "predicted")
    at = docs.columns.index(text_col)
    shipped = Shipped(docs.sparkSession, (model.terms, model.weights, model.bias))

    def run(batches):
        terms, weights, bias = shipped.get()
        matcher = Matcher(Lexicon(terms))
        for batch in batches:
            for begin, texts in text_slices(batch.column(at)):
                z = np.array([matcher.features(t) for t in texts]) @ weights + bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())],
                                                 names=[*part.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, plus(docs.schema, "score double, predicted int"))
