"""Derived feature blocks: degree-2 interactions (F10) and TF-IDF."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.text import english_stop_words, tokens
from cohortkit.session import checkpoint_dir


def interaction_inputs(df: DataFrame, max_inputs: int = 10, exclude: Sequence[str] = ()) -> list[str]:
    """The first ``max_inputs`` 64-bit numeric columns in schema order."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.LongType, T.DoubleType)) and f.name not in set(exclude)]
    return cols[:max_inputs]


def interactions(df: DataFrame, cols: Sequence[str] | None = None, max_inputs: int = 10,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """every square and pairwise product of the input columns, named
    ``interaction_{a}^2`` and ``interaction_{a} {b}`` in polynomial order
    (a², ab, ac, …, b², bc, …), all in one projection."""
    cols = list(cols) if cols is not None else interaction_inputs(df, max_inputs, exclude)
    exprs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            name = f"interaction_{a}^2" if a == b else f"interaction_{a} {b}"
            exprs.append((F.col(a).cast("double") * F.col(b).cast("double")).alias(name))
    return df.select("*", *exprs)


def text_digest(text: str):
    """SHA-256 of the text, 32 bytes; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def term_counts(df: DataFrame, text: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """``(digest, term, n)``: occurrences of each term over all rows of a
    text, and under the NULL term the number of these rows.  Stop words are
    removed.  Texts are tokenized where they are read; only digests and
    partially summed counts are shuffled.  The digest is made once a text, in a
    projection below the one that takes the tokens apart."""
    stop = list(english_stop_words() if stop_words is None else stop_words)
    marked = F.concat(F.array(F.lit(None).cast("string")), tokens(text))
    tok = df.select(text_digest(text).alias("digest"), marked.alias("terms")).select("digest", F.explode("terms").alias("term"))
    if stop:
        tok = tok.where(F.col("term").isNull() | ~F.col("term").isin(stop))
    return tok.groupBy("digest", "term").agg(F.count(F.lit(1)).alias("n"))


def tfidf_vocabulary(counts: DataFrame, max_features: int = 100) -> list[tuple[str, float]]:
    """Top ``max_features`` terms by corpus frequency (ties: term ascending),
    returned in term order with the smoothed idf ln((1+n)/(1+df)) + 1, where
    n and df count rows.  Bounded metadata: at most ``max_features`` rows
    reach the driver."""
    terms = counts.where(F.col("term").isNotNull())
    top = terms.groupBy("term").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)
    names = sorted(r["term"] for r in top.collect())
    rows = counts.where(F.col("term").isNull()).select("digest", F.col("n").alias("rows"))
    n_rows = rows.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    df = terms.where(F.col("term").isin(names)).join(rows, "digest").groupBy("term").agg(F.sum("rows").alias("df")) if names else None
    seen = {r["term"]: r["df"] for r in df.collect()} if names else {}
    return [(t, math.log((1.0 + n_rows) / (1.0 + seen[t])) + 1.0) for t in names]


def tfidf_features(df: DataFrame, text: str, max_features: int = 100,
                   stop_words: Sequence[str] | None = None, prefix: str | None = None) -> DataFrame:
    """TF-IDF block ``{text}_tfidf_{i}`` (i = position of the term in
    the sorted vocabulary), raw counts × smoothed idf, L2-normalised per
    row.  Every row is a document; rows without vocabulary terms get zeros.

    Work: one tokenizing pass feeds partially summed counts per (text
    digest, term), kept in a reliable checkpoint; the vocabulary (at most
    ``max_features`` rows to the driver) and the weights read that copy.
    The weights of each distinct text become one map of at most
    ``max_features`` entries, joined back on the digest.
    """
    prefix = prefix or f"{text}_tfidf"
    checkpoint_dir(df.sparkSession)
    counts = term_counts(df, text, stop_words).checkpoint(eager=True)
    vocab = tfidf_vocabulary(counts, max_features)
    if not vocab:
        return df
    names = [f"{prefix}_{i}" for i in range(len(vocab))]
    table = df.sparkSession.createDataFrame([(t, i, w) for i, (t, w) in enumerate(vocab)], "term string, i int, idf double")
    rows = counts.where(F.col("term").isNull()).select("digest", F.col("n").alias("rows"))
    # The vocabulary has at most max_features rows.
    w = counts.join(F.broadcast(table), "term").join(rows, "digest").select("digest", "i", (F.col("n") / F.col("rows") * F.col("idf")).alias("w"))
    per_text = w.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("i", "w"))).alias("_ck_m"),
                                       F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_ck_norm"))
    wide = per_text.select(F.col("digest").alias("_ck_digest"), *[(F.coalesce(F.col("_ck_m")[i], F.lit(0.0)) / F.col("_ck_norm")).alias(nm)
                                                                 for i, nm in enumerate(names)])
    j = df.withColumn("_ck_digest", text_digest(text)).join(wide, "_ck_digest", "left")
    return j.select(*[F.col(c) for c in df.columns], *[F.coalesce(F.col(nm), F.lit(0.0)).alias(nm) for nm in names])
