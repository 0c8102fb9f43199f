"""Filter interaction audit: what every order of five filters keeps, from one word per document.

A document that fails the filters of a set F survives exactly the subsets of filters that are disjoint from F.
Its 32-bit word has bit S set where it survives subset S (bit i of S is the i-th filter).  Sums over documents
of every bit position then answer every order: after the filters of a prefix, what is left is the count
of that prefix's bit.

Words of one part and label class are added by carry-save adders: three words of equal weight become a word of
sums and one of carries, so n words take about n vector steps, and at the end few words per weight are
read bit by bit.  Tasks hand on 32 counts per part and class, which Spark adds.

Fixed failure conditions (words: runs of other than space, tab to carriage return; case-sensitive):
A fewer than 200 words; B 100 * distinct words < 50 * words; C 100 * capitals A-Z > 2 * code points; D holds any of #$%&*|;
E the same text as a document of smaller id, in the whole table, whether or not that one is removed.

Shuffles carry ids, digests and part names, never texts.  Equal texts meet in an aggregate of their least id,
combined before the shuffle; the result is joined by (id, digest), so a text with very many copies makes no hot key.
Rows without an id are kept out of the joins, for they have no smaller and no label.

Defined cases: a null text is empty; a null part is the empty string; a row without an id fails no E and has no
label; several label rows of an id count as one that has a label where any has it; repeated rows are each a document, and
fail E only for a smaller id; other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
SPACE = "[\\x20\\x09-\\x0D]+"


def failures(text: Column) -> Column:
    """Bits 0 to 3: whether a text fails A, B, C or D."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, capitals = F.size(words), F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [n < 200, F.size(F.array_distinct(words)) * 100 < n * 50, capitals.cast("bigint") * 100 > F.char_length(text).cast("bigint") * 2,
             text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def survival_word(failed: int) -> int:
    """The word of a document that fails the filters of ``failed``, as a signed 32-bit number."""
    word = sum(1 << s for s in range(SUBSETS) if not s & failed)
    return word - (1 << 32) if word >> 31 else word


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set, lowest first, by carry-save addition."""
    total = np.zeros(32, np.int64)
    weight, level = 1, words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c, rest = level[:third], level[third:2 * third], level[2 * third:3 * third], level[3 * third:]
            carries.append((a & b) | (c & (a ^ b)))
            level = np.concatenate([a ^ b ^ c, rest])
        for word in level:  # at most two
            total += weight * ((int(word) >> np.arange(32)) & 1)
        weight, level = 2 * weight, np.concatenate(carries) if carries else level[:0]
    return total


def words_of(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, class, word`` of every document; class has bit 0 where quality is 1 and bit 1 where toxic is."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                              F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("failed")), "survival-rows")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 2).otherwise(0)).alias("toxic"))
    named = rows.where("id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    named = named.join(first, ["id", "digest"], "left").join(marks, "id", "left").select(
        "part", (F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("class"),
        (F.col("failed") + F.when(F.col("is_first"), 0).otherwise(16)).alias("failed"))
    every = named.unionByName(rows.where("id IS NULL").select("part", F.lit(0).alias("class"), "failed"))
    return every.select("part", "class", F.element_at(F.lit([survival_word(m) for m in range(SUBSETS)]), F.col("failed") + 1).alias("word"))


def subset_survivors(words: DataFrame) -> DataFrame:
    """``part, class, kept``: an array of the documents that survive each subset of filters."""

    def count(batches):
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch["part"].dictionary_encode(), batch["class"], batch["word"]], names=["part", "class", "word"])
            group = np.asarray(batch["part"].indices, np.int64) * 4 + np.asarray(batch["class"])
            order = np.argsort(group, kind="stable")
            word, group = np.asarray(batch["word"]).view(np.uint32)[order], group[order]
            keys, begins = np.unique(group, return_index=True)
            counts = [positional_counts(w) for w in np.split(word, begins[1:])] if len(keys) else []
            yield pa.RecordBatch.from_arrays(
                [batch["part"].dictionary.take(pa.array(keys // 4)), pa.array((keys % 4).astype(np.int32)), pa.array([c.tolist() for c in counts], pa.list_(pa.int64()))],
                names=["part", "class", "kept"])

    counted = words.mapInArrow(count, "part string, class int, kept array<bigint>")
    return counted.groupBy("part", "class").agg(F.array(*[F.sum(F.col("kept")[s]) for s in range(SUBSETS)]).alias("kept"))


def audit(survivors: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``subset_survivors``."""
    def of(*classes):
        return F.array(*[F.coalesce(F.sum(F.when(F.col("class").isin(*classes), F.col("kept")[s])), F.lit(0)) for s in range(SUBSETS)])

    parts = survivors.groupBy("part").agg(of(0, 1, 2, 3).alias("all"), of(1, 3).alias("good"), of(2, 3).alias("toxic"))
    steps = [("".join(p), k, [1 << FILTERS.index(f) for f in p[:k]]) for p in permutations(FILTERS) for k in range(1, len(FILTERS) + 1)]
    at = lambda values: F.element_at(F.lit(values), F.col("no") + 1)
    lost = lambda column, old, new: F.col(column)[old] - F.col(column)[new]

    def share(f):
        """What a filter removes in all orders: |S|! (4 - |S|)! of them begin with the set S and go on with it."""
        ways = [factorial(bin(s).count("1")) * factorial(len(FILTERS) - 1 - bin(s).count("1")) for s in range(SUBSETS) if not s & f]
        return sum((n * lost("all", s, s | f) for n, s in zip(ways, (s for s in range(SUBSETS) if not s & f))), F.lit(0).cast("bigint"))

    shares = F.create_map(*[x for f in range(len(FILTERS)) for x in (F.lit(1 << f), share(1 << f))])
    rows = parts.withColumn("shares", shares).withColumn("no", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).withColumns({
        "own": at([used[-1] for _, _, used in steps]), "before": at([sum(used[:-1]) for _, _, used in steps]), "after": at([sum(used) for _, _, used in steps])})
    removed = lost("all", F.col("before"), F.col("after"))
    return rows.select(
        "part", at([o for o, _, _ in steps]).alias("filter_order"), at([k for _, k, _ in steps]).cast("int").alias("step"), F.col("all")[F.col("after")].alias("kept"),
        removed.alias("removed"), (lost("all", F.lit(0), F.col("own")) - removed).alias("redundant"),
        lost("all", SUBSETS - 1 - F.col("own"), F.lit(SUBSETS - 1)).alias("unique_fails"),
        lost("good", F.col("before"), F.col("after")).alias("good_lost"), lost("toxic", F.col("before"), F.col("after")).alias("toxic_lost"),
        F.col("shares")[F.col("own")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs`` by their source, with the losses among labelled documents."""
    return audit(subset_survivors(words_of(docs, labels)))
