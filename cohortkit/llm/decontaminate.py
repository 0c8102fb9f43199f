"""Benchmark decontamination with a generalised suffix automaton.

The words of all items form one automaton that accepts every substring of
every item.  A document's words stream through it once; after each word it
holds the longest suffix that some item contains.  Where that is ``window``
words or more, the last ``window`` words are a window of the items recorded
at the state that holds them; an item shorter than a window is found at the
state of its last word.  Time is linear in the document, memory in the items.

The automaton is built from at most ``shard_bytes`` of item text and is
broadcast; a larger set of items is split into shards by a hash, each with a
pass of its own, so any size gives whole results.  Documents are never
shuffled.

Defined cases: null texts have no words and match nothing; items without words
are never found; repeated items count once; an item without an id marks words
but is not listed; repeated documents and extra columns are kept; columns with
the names of the added ones are replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shipped, free_name, plus, stored, text_slices, without

#: A-Z to a-z; what is neither a digit, a letter nor part of a non-ASCII character to a space.
NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class SuffixAutomaton:
    """States are numbers; ``step[s]`` maps a word id to the next state, ``link`` is the
    state of the longest suffix kept apart, ``size`` the length of a state's longest string."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.step: list[dict] = [{}]
        self.link, self.size = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                coded.append((item, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self.least = min([window, *(len(ids) for _, ids in coded)])
        self._record(coded)

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q that ends where p + w does; those who reach q by shorter strings go to it."""
        clone = len(self.step)
        self.step.append(dict(self.step[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:  # an earlier item has this prefix as a substring
            return q if self.size[q] == self.size[last] + 1 else self._split(last, w, q)
        new = len(self.step)
        self.step.append({})
        self.size.append(self.size[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, w, q)
        return new

    def _holder(self, s: int) -> int:
        """The state among s and its suffixes that holds the suffix of ``window`` words."""
        seen = []
        while s not in self.holder and self.size[self.link[s]] >= self.window:
            seen.append(s)
            s = self.link[s]
        s = self.holder.get(s, s)
        self.holder.update((x, s) for x in seen)
        return s

    def _record(self, coded) -> None:
        """Which items have a window at which state, and the short items that end at each state."""
        self.holder: dict[int, int] = {}
        self.windows: dict[int, set] = {}
        short: dict[int, list] = {}
        for item, ids in coded:
            s = 0
            for i, w in enumerate(ids, 1):
                s = self.step[s][w]
                if i >= self.window:
                    self.windows.setdefault(self._holder(s), set()).add(item)
            if len(ids) < self.window:
                short.setdefault(s, []).append((len(ids), item))
        self.short: dict[int, list] = {}
        if short:
            for s in sorted(range(1, len(self.step)), key=self.size.__getitem__):
                found = short.get(s, []) + self.short.get(self.link[s], [])
                if found:
                    self.short[s] = found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged (first, end) word ranges of all occurring windows, and the items that have them."""
        code = self.vocab.get
        step, link, size, short, window = self.step, self.link, self.size, self.short, self.window
        spans: list[tuple[int, int]] = []
        items: set = set()
        s = length = run = 0
        for i, w in enumerate(words, 1):
            c = code(w)
            if c is None:
                s = length = 0
                continue
            while s and c not in step[s]:
                s = link[s]
                length = size[s]
            if c in step[s]:
                s = step[s][c]
                length += 1
            if length >= self.least:
                run = 0
                if length >= window:
                    items |= self.windows[self._holder(s)]
                    run = window
                for k, item in short.get(s, ()):
                    if k <= length:
                        items.add(item)
                        run = max(run, k)
                if run:
                    first = i - run
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return spans, items


def _shards(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, window: int, shard_bytes: int):
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    n = max(1, -(-size // shard_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield Shipped(spark, SuffixAutomaton([(r["item"], words_of(r["text"].encode())) for r in part.toLocalIterator()], window))


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
         window: int = 10, shard_bytes: int = 2 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (merged word ranges, end exclusive) and ``items``
    (ids of items with an occurring window, distinct, sorted as strings)."""
    spark = docs.sparkSession
    out = without(docs, "n_words", "hits", "items")
    at = out.columns.index(text_col)
    span = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
    names = [*out.columns, "n_words", "hits", "items"]
    schema = plus(out.schema, "n_words bigint, hits array<struct<first:bigint,stop:bigint>>, items array<string>")
    for k, automaton in enumerate(_shards(spark, items, item_col, item_text_col, window, shard_bytes)):
        if k:
            out = stored(out, "decontaminate-pass")

        def run(batches, automaton=automaton, first=k == 0):
            own = automaton.get()
            for batch in batches:
                for begin, texts in text_slices(batch.column(at)):
                    part = batch.slice(begin, len(texts))
                    keep = part.columns if first else part.columns[:-3]
                    had = [([], [])] * len(texts) if first else list(zip(part.column(-2).to_pylist(), part.column(-1).to_pylist()))
                    counts, hits, found = [], [], []
                    for t, (old_hits, old_items) in zip(texts, had):
                        words = words_of(t)
                        spans, ids = own.scan(words)
                        counts.append(len(words))
                        hits.append(_merged([*spans, *((h["first"], h["stop"]) for h in old_hits)]))
                        found.append(sorted({*(x for x in ids if x is not None), *old_items}))
                    yield pa.RecordBatch.from_arrays(
                        [*keep, pa.array(counts, pa.int64()), pa.array([[{"first": a, "stop": b} for a, b in h] for h in hits], span),
                         pa.array(found, pa.list_(pa.string()))], names=names)

        out = out.mapInArrow(run, schema)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def n_hit(hits: str = "hits"):
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["stop"] - h["first"])


def cut(text: bytes, hits: list[tuple[int, int]]) -> bytes:
    """``text`` without the given word ranges: from the first to the last word of each."""
    at = [m.span() for m in WORD.finditer(text.translate(NORMAL))]
    out, begin = [], 0
    for first, stop in hits:
        out.append(text[begin:at[first][0]])
        begin = at[stop - 1][1]
    return b"".join([*out, text[begin:]])


def remove(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           max_coverage: float = 0.5, window: int = 10, shard_bytes: int = 2 << 20) -> DataFrame:
    """``docs`` without the spans of benchmark windows.  Documents that lose more than
    ``max_coverage`` of their words go.  A cut can bring two halves of a window
    together, so texts are scanned until nothing is found; others are unchanged."""
    names = docs.columns
    at = names.index(text_col)
    n_words, n_cut = free_name(docs, "n_words"), free_name(docs, "n_cut")
    own = plus(docs.schema, f"{n_words} bigint, {n_cut} bigint")
    left = docs.withColumns({n_words: F.lit(None).cast("bigint"), n_cut: F.lit(0).cast("bigint")})
    automata = list(_shards(docs.sparkSession, items, item_col, item_text_col, window, shard_bytes))
    again = True
    while again:
        for automaton in automata:

            def run(batches, automaton=automaton):
                scan = automaton.get().scan
                for batch in batches:
                    for begin, texts in text_slices(batch.column(at)):
                        part = batch.slice(begin, len(texts))
                        total, gone, new = part.column(-2).to_pylist(), part.column(-1).to_pylist(), []
                        for i, t in enumerate(texts):
                            words = words_of(t)
                            if total[i] is None:
                                total[i] = len(words)
                            while hits := scan(words)[0]:
                                gone[i] += sum(b - a for a, b in hits)
                                t = cut(t, hits)
                                words = words_of(t)
                            new.append(t)
                        changed = pa.array(new, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
                        whole = pa.compute.if_else(pa.compute.is_null(part.column(at)), part.column(at), changed)
                        columns = [whole if i == at else c for i, c in enumerate(part.columns[:-2])]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=batch.schema.names)

            left = left.mapInArrow(run, own)
        again = False
        if len(automata) > 1:  # a cut for one shard may have joined what another one finds
            left = stored(left, "decontaminate-round")
            again = any(find(left.select(F.col(f"`{text_col}`").alias("text")), part, window=window, item_col="item", item_text_col="text",
                             shard_bytes=shard_bytes).filter(F.size("hits") > 0).limit(1).count()
                        for part in [items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))])
    return left.filter(F.col(n_cut) <= F.coalesce(F.col(n_words), F.lit(0)) * max_coverage).select(*[F.col(f"`{c}`") for c in names])
