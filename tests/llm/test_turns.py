"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import turns

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def edits(symbols):
    """The least string of cheapest edits, by search over (row, what the roles so far match)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}  # the last role says all

    @lru_cache(None)
    def best(i, last, inserted):
        found = []
        if i == len(symbols) and last in ("", "a"):
            found.append((0, ""))
        if inserted < 2:
            found += [(3 + c, "I" + t) for r in "ua" if r in follows[last] for c, t in [best(i, r, inserted + 1)]]
        if i < len(symbols):
            role, fault = symbols[i]
            c, t = best(i + 1, last, 0)
            found.append((4 + c, "D" + t))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                found += [(extra + c, "K" + t) for c, t in [best(i + 1, role, 0)]] if role and role in follows[last] else []
                found += [(3 + extra + c, "R" + t) for r in "ua" if r in follows[last] for c, t in [best(i + 1, r, 0)]]
        return min(found, default=(10 ** 9, ""))
    return best(0, "", 0)


def repaired(rows, audit):
    out, at, last = [], 0, ""
    for letter in audit:
        wanted = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if letter == "I":
            out.append(wanted + ":")
        else:
            role, text = rows[at][2:]
            at += 1
            if letter == "D":
                continue
            wanted = role if letter == "K" else wanted
            out.append(f"{wanted}:{text}")
        last = wanted[0]
    assert at == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return "\n".join(out)


def brute(rows):
    left, out = damaged(rows), {}
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, symbols = set(), []
        for _, _, role, text in own:
            solid = text.strip(SPACE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            symbols.append((role[:1], fault))
        cost, audit = edits(tuple(symbols))
        numbers = [r[1] for r in own if r[1] is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *[sum(f == k for _, f in symbols) for k in ("blank", "duplicate", "truncated")],
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:])), cost, audit,
                     hashlib.sha256(repaired(own, audit).encode()).hexdigest())
    return out


def conversations(n, seed):
    rng, rows = random.Random(seed), []
    texts = ["Good.", "Fine!", "cut", " \n\t", "", None, "Really? ", "a.b", "x ", "Ends?\x0b", "long " * 50 + "end."]
    for conv in range(n):
        for turn in range(rng.randrange(0, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "sys"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3, 2]), role, rng.choice(texts)))
    rows += [(None, t, r, "Hm.") for t, r in enumerate(["system", "user", "user", "user", "assistant"])] + rows[5:9] + rows[5:7]
    return rows


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


@pytest.mark.parametrize("ranges", [1, 8, 61])
def test_repair_equals_brute_force(spark, ranges):
    rows = conversations(60, 5)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("conv", "seg", "digest", "copies", "Audit")]).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        assert got(turns.repair(turns.damage(df))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_conversation_over_many_ranges(spark):
    """One conversation holds nearly all rows: it is cut into segments and chained."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), rng.choice(["Yes.", "No", f"turn {t}.", f"turn {t}"])) for t in range(900)] + [(8, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    import sys
    sys.setrecursionlimit(20_000)
    assert got(turns.repair(turns.damage(df))) == brute(rows)


def test_nothing_left_and_empty_table(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    out = got(turns.repair(turns.damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], schema))))
    assert out == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert turns.repair(turns.damage(spark.createDataFrame([], schema))).count() == 0


def test_powers_equal_single_steps():
    powers = turns.Powers()
    for symbol in "suaoSUAO-":
        vector = turns.AT_END
        for n in range(1, 40):
            vector = turns.then(powers.of(symbol, 0), vector)
            assert (powers.advance(symbol, n, turns.AT_END) == vector).all()
    assert (turns.matrix_of([("u", 5), ("-", 3)], powers) == turns.matrix_of([("u", 2), ("u", 3), ("-", 1), ("-", 2)], powers)).all()
    assert turns.unroll("u", 10, turns.AT_END, 0, powers, block=3) == turns.unroll("u", 10, turns.AT_END, 0, powers)


def test_long_runs_take_few_products(monkeypatch):
    made = []
    monkeypatch.setattr(turns, "then", lambda a, b, f=turns.then: made.append(1) or f(a, b))
    turns.Powers().advance("u", 10 ** 9, np.array(turns.AT_END))
    assert len(made) < 70
