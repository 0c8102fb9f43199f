"""Token counts without ids.

Every distinct word is counted once (the frequent ones in a broadcast table
of bounded size, ``packed_words`` more in a packed one of 17 bytes a word, the others once per slice of texts, see ``word_table``),
joined to the word frequencies of each document, and summed.  Texts are not
shuffled and no ids of a text are made.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows
and extra columns are kept; columns with the names of the added ones are
replaced.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shipped, plus, text_slices, without
from .word_table import Words, encoded, least_bins, packed_counts, repeated_words, require_word_tokenizer


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", limit: int = 2048, max_words: int = 150_000,
                 packed_words: int = 2_000_000) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    require_word_tokenizer(tokenizer)
    docs = without(docs, "n_bytes", "n_tokens", "over_limit")
    at = docs.columns.index(text_col)
    counts = repeated_words(docs, text_col)
    frequent, rest = least_bins(counts, max_words, max_words + packed_words)
    rows = encoded(counts.filter(F.col("bin") >= frequent), tokenizer).selectExpr("word", "size(ids) AS n").toArrow()
    packed = Shipped(docs.sparkSession, packed_counts(counts.filter((F.col("bin") >= rest) & (F.col("bin") < frequent)), tokenizer))
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(rows["word"].to_pylist(), rows["n"].to_pylist())))

    def run(batches):
        known = Words(table.value, tokenizer, len, packed.get())
        for batch in batches:
            for begin, texts in text_slices(batch.column(at), 1 << 20):
                freqs = [Counter(t.split()) for t in texts]
                known.ready(freqs)
                sums = [sum(map(int.__mul__, known.of(f), f.values())) for f in freqs]
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([len(t) for t in texts], pa.int64()), pa.array(sums, pa.int64()),
                     pa.array([s > limit for s in sums], pa.bool_())],
                    names=[*part.schema.names, "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(run, plus(docs.schema, "n_bytes bigint, n_tokens bigint, over_limit boolean"))
