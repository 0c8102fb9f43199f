"""Distinct-word table for a tokenizer that drops white space.

Such a tokenizer's ids of a text are those of its white-space-separated words,
one after the other, so a word needs encoding once.  ``word_table`` counts all
words of all texts in Spark, keeps the most frequent ``max_words`` of at most
``MAX_WORD_BYTES`` bytes and encodes each of them once.  That table is bounded
by its two parameters and is broadcast.  ``Words`` looks words up in it; words
outside the table (each is rare, but there is no bound on how many there are)
are encoded once per slice of texts in the task that reads them, so nothing is
left out and no text is shuffled.

Words are split at ASCII white space only.  Everything else (other white
space, case, normal forms, special strings) is left to the tokenizer, for
which ASCII white space is always a boundary.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices, tokenizer_path, worker_cache

#: Longest word the broadcast table takes.
MAX_WORD_BYTES = 48
#: Words a task counts before it hands its counts on, and rare words it keeps encoded.
FLUSH_WORDS = 300_000
TAIL_WORDS = 100_000


def load_tokenizer(name: str):
    """The tokenizer of this process, loaded once per Python worker."""
    cache = worker_cache()
    if ("tokenizer", name) not in cache:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(tokenizer_path(name))
        tok.no_padding()
        tok.no_truncation()
        cache["tokenizer", name] = tok
    return cache["tokenizer", name]


def require_word_tokenizer(name: str) -> None:
    """Raise unless the tokenizer splits at white space and drops it."""
    with open(tokenizer_path(name), encoding="utf-8") as f:
        conf = json.load(f)
    steps = conf["pre_tokenizer"].get("pretokenizers", [conf["pre_tokenizer"]])
    if not any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps) or any(s.get("add_prefix_space") for s in steps):
        raise ValueError(f"{name} keeps white space, so its words can't be encoded one by one")
    if any(" " in t["content"] for t in conf["added_tokens"]):
        raise ValueError(f"{name} has an added token with white space")


def encode_words(tokenizer: str, words: list[bytes]) -> list[list[int]]:
    tok = load_tokenizer(tokenizer)
    return [e.ids for e in tok.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` over all whole texts; tasks hand on partial counts."""

    def count(batches):
        have: Counter = Counter()

        def rows():
            out = pa.record_batch({"word": pa.array(list(have), pa.binary()), "n": pa.array(list(have.values()), pa.int64())})
            have.clear()
            return out

        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                for t in texts:
                    have.update(t.split())
                if len(have) >= FLUSH_WORDS:
                    yield rows()
        if have:
            yield rows()

    return (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def repeated_words(docs: DataFrame, text_col: str) -> DataFrame:
    """``word, n, bin`` of the words that occur more than once and are not overlong; a bin is a sixteenth of a doubling of n."""
    counts = word_counts(docs, text_col).filter((F.col("n") > 1) & (F.octet_length("word") <= MAX_WORD_BYTES))
    return stored(counts.withColumn("bin", F.floor(F.log2("n") * 16)), "word-counts")


def least_bins(counts: DataFrame, *sizes: int) -> list[int]:
    """For each size the least bin from which up at most so many words qualify."""
    bins = counts.groupBy("bin").count().orderBy(F.desc("bin")).collect()  # under 1,024
    out = []
    for size in sizes:
        least, total = 1 << 30, 0
        for b in bins:
            total += b["count"]
            if total > size:
                break
            least = b["bin"]
        out.append(least)
    return out


def word_table(docs: DataFrame, text_col: str, tokenizer: str, max_words: int = 150_000) -> DataFrame:
    """``word, n, ids`` of the most frequent words of ``docs``, each encoded once.

    The least count that enters is the smallest for which at most
    ``max_words`` words qualify, read from a histogram of counts.
    """
    counts = repeated_words(docs, text_col)
    return encoded(counts.filter(F.col("bin") >= least_bins(counts, max_words)[0]), tokenizer)


def encoded(top: DataFrame, tokenizer: str) -> DataFrame:
    """``word, n, ids`` of the words of ``top``."""

    def encode(batches):
        for batch in batches:
            ids = encode_words(tokenizer, batch.column(0).to_pylist())
            yield pa.record_batch({"word": batch.column(0), "n": batch.column(1), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return stored(top.select("word", "n").mapInArrow(encode, "word binary, n bigint, ids array<int>"), "word-table")


class PackedCounts:
    """Token counts of many words in 17 bytes a word: sorted halves of their 128-bit hashes, the other halves, and the counts."""

    def __init__(self, low: np.ndarray, high: np.ndarray, count: np.ndarray):
        order = np.argsort(low)
        self.low, self.high, self.count = low[order], high[order], count[order]

    def split(self, words: list[bytes]) -> tuple[list[bytes], list[int], list[bytes]]:
        """The words held here, their counts, and the other words."""
        if not len(self.low) or not words:
            return [], [], words
        halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
        at = np.minimum(np.searchsorted(self.low, halves[:, 0]), len(self.low) - 1)
        held = (self.low[at] == halves[:, 0]) & (self.high[at] == halves[:, 1])
        return [w for w, h in zip(words, held) if h], self.count[at[held]].tolist(), [w for w, h in zip(words, held) if not h]


def packed_counts(top: DataFrame, tokenizer: str) -> PackedCounts:
    """The token counts of the words of ``top`` (a bounded number of them), each encoded once."""

    def encode(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            ids = encode_words(tokenizer, words)
            keep = [i for i, x in enumerate(ids) if len(x) < 256]
            halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(words[i]) for i in keep), "<i8").reshape(-1, 2)
            yield pa.record_batch({"low": pa.array(halves[:, 0]), "high": pa.array(halves[:, 1]), "n": pa.array([len(ids[i]) - 128 for i in keep], pa.int8())})

    rows = top.select("word").mapInArrow(encode, "low bigint, high bigint, n tinyint").toArrow()
    low, high, n = (np.asarray(rows[c].combine_chunks() if rows.num_rows else [], t) for c, t in (("low", np.int64), ("high", np.int64), ("n", np.int16)))
    return PackedCounts(low.view(np.uint64), high.view(np.uint64), (n + 128).astype(np.uint8))


class Words:
    """word -> value, from the broadcast table or else encoded here.

    ``value`` turns a list of ids into what is kept.  ``packed`` may hold the values of
    many more words, where these are counts.  At most ``TAIL_WORDS``
    rare words stay from slice to slice.
    """

    def __init__(self, table: dict, tokenizer: str, value, packed: PackedCounts | None = None):
        self.table, self.tokenizer, self.value, self.tail, self.packed = table, tokenizer, value, {}, packed

    def ready(self, texts: list[list[bytes]]) -> None:
        """Encode, once each, the words of a slice that are not known yet."""
        new: set = set()
        for words in texts:
            new.update(words)
        new = [w for w in new if w not in self.table and w not in self.tail]
        if len(self.tail) + len(new) > TAIL_WORDS:
            self.tail.clear()
            new = list({w for words in texts for w in words if w not in self.table})
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            if self.packed:
                held, counts, part = self.packed.split(part)
                self.tail.update(zip(held, counts))
            self.tail.update(zip(part, map(self.value, encode_words(self.tokenizer, part))))

    def of(self, words: list[bytes]) -> list:
        table, tail = self.table, self.tail
        return [table[w] if w in table else tail[w] for w in words]
