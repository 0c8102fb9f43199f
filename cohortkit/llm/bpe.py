"""BPE encoding and decoding through a distinct-word table.

``encode`` adds the ids of every whole text, ``decode`` the text of every id
row.  Words are counted and encoded once in Spark (see ``word_table``); their
ids are joined back by position in one pass over the texts, which are never
shuffled.  Decoding joins ids to the vocabulary's pieces, a table as large as
the vocabulary.  ``round_trip`` does both in one pass.

Ids are kept packed: little-endian unsigned 32-bit integers in a binary
column.  Defined cases: a null or empty text has no ids and decodes to the
empty text; ids outside the vocabulary decode to nothing, as in the tokenizer's own
decoding; repeated rows and extra columns are kept; a column that already has
the name of the added one is replaced.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import plus, text_slices, without
from .word_table import Words, load_tokenizer, require_word_tokenizer, word_table


def _with(batch: pa.RecordBatch, begin: int, n: int, name: str, column: pa.Array) -> pa.RecordBatch:
    part = batch.slice(begin, n)
    return pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, name])


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _encoder(docs: DataFrame, tokenizer: str, text_col: str, ids_col: str, max_words: int):
    """The function from batches of ``docs`` to batches with their ids."""
    require_word_tokenizer(tokenizer)
    at = docs.columns.index(text_col)
    rows = word_table(docs, text_col, tokenizer, max_words).select("word", "ids").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(rows["word"].to_pylist(), map(_pack, rows["ids"].to_pylist()))))

    def run(batches):
        known = Words(table.value, tokenizer, _pack)
        for batch in batches:
            for begin, texts in text_slices(batch.column(at), 1 << 20):
                words = [t.split() for t in texts]
                known.ready(words)
                ids = [b"".join(known.of(w)) for w in words]
                yield _with(batch, begin, len(texts), ids_col, pa.array(ids, pa.binary()))

    return run


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", max_words: int = 150_000) -> DataFrame:
    """``docs`` with ``ids_col``, the packed ids of the whole text."""
    docs = without(docs, ids_col)
    return docs.mapInArrow(_encoder(docs, tokenizer, text_col, ids_col, max_words), plus(docs.schema, f"`{ids_col}` binary"))


def pieces(tokenizer: str) -> list[bytes | None]:
    """The vocabulary's piece of every id, in UTF-8."""
    vocab = load_tokenizer(tokenizer).get_vocab(with_added_tokens=True)
    out: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = piece.encode()
    return out


def _decoder(spark: SparkSession, tokenizer: str, ids_col: str, text_col: str):
    """The function from batches with ids to batches with the text of those ids."""
    if getattr(load_tokenizer(tokenizer), "decoder", None) is not None:
        raise ValueError(f"{tokenizer} has a decoder of its own")
    vocab = spark.sparkContext.broadcast(pieces(tokenizer))  # as large as the vocabulary

    def run(batches):
        of = vocab.value
        known = all(p is not None for p in of)
        for batch in batches:
            for begin, packed in text_slices(batch.column(ids_col), 2 << 20):
                texts = []
                for row in packed:
                    ids = np.frombuffer(row, "<u4")
                    if known and (not len(ids) or ids.max() < len(of)):
                        texts.append(b" ".join(map(of.__getitem__, ids.tolist())))
                    else:
                        texts.append(b" ".join(of[i] for i in ids.tolist() if i < len(of) and of[i] is not None))
                yield _with(batch, begin, len(packed), text_col, pa.array(texts, pa.binary()).cast(pa.string()))

    return run


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``text_col``: the pieces of its ids, special ones included,
    joined by spaces as the tokenizer does without a decoder."""
    encoded = without(encoded, text_col)
    return encoded.mapInArrow(_decoder(encoded.sparkSession, tokenizer, ids_col, text_col), plus(encoded.schema, f"`{text_col}` string"))


def round_trip(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded",
               max_words: int = 150_000) -> DataFrame:
    """``encode`` and then ``decode`` in one pass, without the original text: one
    Python worker a task instead of two, and neither the text nor the ids cross
    between workers."""
    docs = without(docs, ids_col, decoded_col)
    rest = StructType([f for f in docs.schema.fields if f.name != text_col])
    encode_batches = _encoder(docs, tokenizer, text_col, ids_col, max_words)
    decode_batches = _decoder(docs.sparkSession, tokenizer, ids_col, decoded_col)

    def run(batches):
        yield from decode_batches(b.drop_columns([text_col]) for b in encode_batches(batches))

    return docs.mapInArrow(run, plus(rest, f"`{ids_col}` binary, `{decoded_col}` string"))


def n_tokens(ids_col: str = "ids"):
    return (F.octet_length(ids_col) / 4).cast("bigint")
