"""The filter audit against a plain count per document, order and step."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from cohortkit.llm import survival


def failed(docs, at):
    i, text = docs[at][0], docs[at][1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
        out.add("E")
    return out


def brute(docs, labels):
    rows, shapley = defaultdict(Counter), Counter()
    for at, (i, _, source) in enumerate(docs):
        fails, part = failed(docs, at), source or ""
        good = any(j == i and i is not None and q == 1 for j, q, _ in labels)
        toxic = any(j == i and i is not None and t == 1 for j, _, t in labels)
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                row, here = rows[part, order, step], f in fails and not gone
                row["removed"] += here
                row["redundant"] += f in fails and gone
                row["unique_fails"] += fails == {f}
                row["good_lost"] += here and good
                row["toxic_lost"] += here and toxic
                shapley[part, f] += here
                gone |= here
                row["kept"] += not gone
    return {(*k, *(v[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def got(df):
    return {tuple(r) for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()}


def cases():
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", " \t\n", "one two", long, long + " $", long.upper(), "a " * 300, "A " * 300 + "#", long + "\x0b\x0c tail", "été É " + long, "x" * 200_000]
    docs = [(i, rng.choice(texts), rng.choice(["web", "hot", "hot", "hot", None, ""])) for i in range(60)]
    docs += [(None, long, "web"), (None, long, None), (7, docs[7][1], "web"), (7, "other", "web"), (-5, long, "web")]
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 60, 2)] + [(None, 1, 1), (4, 1, None), (5, None, None), (4, 1, 1), (999, 1, 1)]
    return docs, labels


def test_audit_equals_brute_force(spark):
    docs, labels = cases()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").select(
        "*", *[F.lit("x").alias(c) for c in ("id", "part", "Digest", "failed", "word", "class", "quality", "toxic")]).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").select("*", F.lit(1).alias("good"), F.lit(2).alias("is_first"))
    out = survival.filter_audit(df, marks)
    assert got(out) == brute(docs, labels)
    assert out.count() == 600 * 3


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert survival.filter_audit(docs, labels).count() == 0
    few = cases()[0][:5]
    assert got(survival.filter_audit(spark.createDataFrame(few, docs.schema), labels)) == brute(few, [])


def test_carry_save_counts_equal_bit_counts():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 4, 7, 1000, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        want = [int((words >> np.uint32(b) & np.uint32(1)).sum()) for b in range(32)]
        assert survival.positional_counts(words).tolist() == want


def test_survival_words():
    for fails in range(32):
        word = survival.survival_word(fails) & 0xFFFFFFFF
        assert [word >> s & 1 for s in range(32)] == [int(not s & fails) for s in range(32)]
