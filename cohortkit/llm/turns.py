"""Conversation structure repair: find faulty turns and the cheapest edits that give a legal sequence of roles.

``damage`` makes test input: by crc32(``conv_id:turn``) % 20 it drops a row (0), empties its text (1), removes its
``[.!?]`` (2), repeats it (3) or gives it the role user (4).

``repair`` orders the rows of a conversation by turn (null first), then role, then digest of the text.  A row's first fault
counts: blank (only white space), duplicate (role and text seen before in the conversation), truncated (the last
other character is none of ``.!?``).  Legal are the role initials ``(s?(ua)+)?``.  Edits: Keep costs 0, Rerole to the
role the grammar asks for 3, Delete 4 (the only choice for blank and duplicate rows), Insert a turn without text 3;
a truncated row that stays adds 3.  Of the cheapest edits those with the ASCII-least string of initials are taken.

The grammar has four states, so what a row's symbol (role initial and fault) does to them is a 4 x 4 matrix of least costs.  Equal consecutive
symbols are a run; a run of n rows is advanced through the cached binary powers of its matrix in log n steps.

1. Rows are cut into ranges of (conversation, order) and stored with their number in that order.  A conversation
   with very many rows thus lies in many ranges.
2. The first row of each (conversation, role, digest) comes from an aggregate combined before the shuffle; its row numbers, not
   the texts, are joined back, on the row number.
3. Each (conversation, range) becomes one *segment*: its runs, its matrix and its counts.
4. Segments of a conversation are chained from the back: cost after each, then within each run by powers; choices are then
   unrolled forward into the audit, one letter an edit.
5. Rows stream past the audit of their conversation into its SHA-256; no task holds a conversation's texts.

Memory: a task of step 3 holds one segment at a time, one of step 4 a conversation's runs and audit (about a byte a row, as in its result),
one of step 5 an audit and a batch of rows.  A digest over a whole conversation is sequential, so step 5 reads one conversation in one task.

Defined cases: a null conversation id is a conversation of its own; null turn, role or text are kept through steps as
one space (turn: null, first in order).  Roles count by their first character, case-sensitive; other or empty roles are
never legal and must be reroled or deleted.  Repeated rows are adjacent and all but the first are duplicates.
A conversation of which no row is left has zeros, an empty audit and the digest of the empty string.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
#: What a turn of each role makes of a state; absent: not legal there.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE_OF = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
NEVER = 1 << 60
#: Symbols: role initial in lower case for a sound row, in upper case for a truncated one ("o": any other role); "-" for rows that must go.
MUST_GO = "-"
SPACE_CHARS = "\\x20\\x09-\\x0D"


def then(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least costs of a followed by b; b may be a vector of costs still to come."""
    out = (a[:, :, None] + b[None] if b.ndim == 2 else a + b).min(1)
    return np.minimum(out, NEVER)


def _plain_step(symbol: str) -> np.ndarray:
    m = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(m, DELETE)
    if symbol != MUST_GO:
        extra = CUT_SHORT if symbol.isupper() else 0
        for state in range(4):
            to = AFTER[WANTED[state]][state]
            m[state, to] = min(m[state, to], REROLE + extra)
            kept = AFTER.get(symbol.lower(), {}).get(state)
            if kept is not None:
                m[state, kept] = min(m[state, kept], extra)
    return m


def _inserts() -> np.ndarray:
    """Least costs of any number of inserted turns."""
    m = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(m, 0)
    for state in range(4):
        one = AFTER[WANTED[state]][state]
        m[state, one] = min(m[state, one], INSERT)
    return then(m, then(m, m))


INSERTS = _inserts()
LEGAL_END = np.array([0, NEVER, NEVER, 0], np.int64)
#: Cost to come after the last row.
AT_END = then(INSERTS, LEGAL_END)


class Powers:
    """Matrices of runs, from binary powers that are worked out once per symbol."""

    def __init__(self):
        self.known: dict[str, list[np.ndarray]] = {}

    def of(self, symbol: str, bit: int) -> np.ndarray:
        have = self.known.setdefault(symbol, [then(INSERTS, _plain_step(symbol))])
        while len(have) <= bit:
            have.append(then(have[-1], have[-1]))
        return have[bit]

    def advance(self, symbol: str, n: int, after: np.ndarray) -> np.ndarray:
        """Costs before a run of ``n`` equal symbols, given those after it (a vector, or a matrix of what follows)."""
        bit = 0
        while n >> bit:
            if n >> bit & 1:
                after = then(self.of(symbol, bit), after)
            bit += 1
        return after


def matrix_of(runs, powers: Powers) -> np.ndarray:
    """The matrix of a sequence of (symbol, length) runs."""
    out = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)
    for symbol, n in reversed(runs):
        out = powers.advance(symbol, n, out)
    return out


def choices(symbol: str, state: int, after: np.ndarray):
    """(letter, next state, cost, whether the row is used up) in ASCII order of the letters; ``after``: costs to come after the row."""
    yield "D", state, DELETE + int(after[state]), True
    to = AFTER[WANTED[state]][state]
    if symbol == MUST_GO:
        yield "I", to, None, False
        return
    extra = CUT_SHORT if symbol.isupper() else 0
    yield "I", to, None, False
    kept = AFTER.get(symbol.lower(), {}).get(state)
    if kept is not None:
        yield "K", kept, extra + int(after[kept]), True
    yield "R", to, REROLE + extra + int(after[to]), True


def unroll(symbol: str, n: int, after: np.ndarray, state: int, powers: Powers, block: int = 4096) -> tuple[str, int]:
    """The least string of cheapest edits over a run of ``n`` rows from ``state``, and the state after it."""
    letters = []
    step = powers.of(symbol, 0)
    for begin in range(0, n, block):
        size = min(block, n - begin)
        costs = [powers.advance(symbol, n - begin - size, after)]
        for _ in range(size):
            costs.append(then(step, costs[-1]))
        for left in range(size, 0, -1):
            used = False
            while not used:
                for letter, to, cost, uses in choices(symbol, state, costs[left - 1]):
                    if (INSERT + int(costs[left][to]) if cost is None else cost) == costs[left][state]:
                        letters.append(letter)
                        state, used = to, uses
                        break
    return "".join(letters), state


def audit_of(segments: list[list[tuple[str, int]]], powers: Powers, matrices: list[np.ndarray] | None = None) -> tuple[int, str]:
    """Least cost and audit of a conversation given as segments of runs."""
    after = [AT_END]
    for i in range(len(segments) - 1, -1, -1):
        after.append(then(matrices[i] if matrices else matrix_of(segments[i], powers), after[-1]))
    state, letters = START, []
    for runs, end in zip(segments, after[-2::-1]):
        costs = [end]
        for symbol, n in reversed(runs):
            costs.append(powers.advance(symbol, n, costs[-1]))
        for (symbol, n), to_come in zip(runs, costs[-2::-1]):
            text, state = unroll(symbol, n, to_come, state, powers)
            letters.append(text)
    while AT_END[state]:  # turns still missing at the end
        letters.append("I")
        state = AFTER[WANTED[state]][state]
    return int(after[-1][START]), "".join(letters)


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` after the damage (copies 0: dropped); nulls of role and text are one space."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written(conv), F.lit(":"), written(turn))) % 20
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(written(role)).alias("role"),
                     F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(written(text), "[.!?]", "")).otherwise(written(text)).alias("text"),
                     F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _segment_rows(batches):
    """One row per conversation and range, from rows in order."""
    powers = Powers()

    def rows():
        for batch in batches:
            yield from zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])

    def packed(group):
        runs, counts, turns, illegal, first, last = [], [0, 0, 0], [None, None, 0], 0, None, None
        for _, _, _, turn, initial, copies, fault, is_first in group:
            for copy in range(copies):
                kind = "blank" if fault == "blank" else "duplicate" if copy or not is_first else fault
                symbol = MUST_GO if kind in ("blank", "duplicate") else initial if initial in ("s", "u", "a") else "o"
                symbol = symbol.upper() if kind == "truncated" else symbol
                for i, name in enumerate(("blank", "duplicate", "truncated")):
                    counts[i] += kind == name
                if runs and runs[-1][0] == symbol:
                    runs[-1][1] += 1
                else:
                    runs.append([symbol, 1])
                illegal += last is not None and last + initial not in ("su", "ua", "au")
                first, last = initial if first is None else first, initial
            if copies and turn is not None:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + (turns[1] != turn)]
        return runs, counts, turns, illegal, first, last

    out = []
    for (conv, seg), group in groupby(rows(), key=lambda r: (r[0], r[1])):
        runs, counts, turns, illegal, first, last = packed(group)
        out.append((conv, seg, "".join(s for s, _ in runs), [n for _, n in runs], matrix_of(runs, powers).ravel().tolist(), *counts, *turns, illegal, first, last))
        if len(out) == 1000:
            yield out
            out = []
    yield out


def _chained_rows(rows):
    """A conversation's result without its digest, from the rows of its segments in order."""
    powers = Powers()
    for conv, group in groupby(rows, key=lambda r: r[0]):
        segments, matrices, totals, turns, last = [], [], [0, 0, 0, 0], [None, None, 0], None
        for _, _, symbols, lengths, matrix, blank, duplicate, truncated, low, high, distinct, illegal, first, end in group:
            segments.append(list(zip(symbols, lengths)))
            matrices.append(np.array(matrix, np.int64).reshape(4, 4))
            across = first is not None and last is not None and last + first not in ("su", "ua", "au")
            totals = [a + b for a, b in zip(totals, (blank, duplicate, truncated, illegal + across))]
            last = last if end is None else end
            if low is not None:
                turns = [low if turns[0] is None else turns[0], high, turns[2] + distinct - (turns[1] == low)]
        cost, letters = audit_of(segments, powers, matrices)
        yield (conv, turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0, *totals, cost, letters)


def _as_batches(chunks, kinds):
    for rows in chunks:
        columns = list(zip(*rows)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def repair(rows: DataFrame) -> DataFrame:
    """From ``conv, turn, role, text, copies`` (see ``damage``): per conversation ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    spark = rows.sparkSession
    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    probe = rows.select("conv", "turn").limit(0).toArrow().schema
    keyed = rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "row": F.monotonically_increasing_id()})
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv", "turn", "role", "digest", "row"]
    placed = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = stored(placed.drop("row").withColumn("at", F.monotonically_increasing_id()), "turns-rows")

    solid = F.regexp_extract("text", f"(?s)([^{SPACE_CHARS}])[{SPACE_CHARS}]*\\z", 1)
    narrow = placed.select("conv", F.shiftright("at", 33).cast("int").alias("seg"), "at", "turn", F.substring("role", 1, 1).alias("initial"), "copies",
                           F.when(solid == "", "blank").when(~solid.isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))
    first = placed.where("copies > 0").groupBy("conv", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    marked = narrow.join(first, "at", "left").select("conv", "seg", "at", "turn", "initial", "copies", "fault", F.coalesce("is_first", F.lit(False)).alias("is_first"))
    seg_kinds = [("conv", probe.field("conv").type), ("seg", pa.int32()), ("symbols", pa.string()), ("lengths", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())),
                 *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated")], ("low", probe.field("turn").type), ("high", probe.field("turn").type),
                 ("distinct", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    segments = marked.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at").mapInArrow(
        lambda batches: _as_batches(_segment_rows(batches), seg_kinds),
        f"conv {conv_type}, seg int, symbols string, lengths array<bigint>, matrix array<bigint>, blank bigint, duplicate bigint, truncated bigint, "
        f"low {turn_type}, high {turn_type}, distinct bigint, illegal bigint, first string, last string")

    done_kinds = [("conv", probe.field("conv").type), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]

    def chain(batches):
        rows = (r for b in batches for r in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]))
        return _as_batches(([r] for r in _chained_rows(rows)), done_kinds)

    done = segments.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(
        chain, f"conv {conv_type}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
    done = stored(done, "turns-audits")

    # Each conversation's result stands before its rows and is passed on, with the digest, after them.
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    heads = done.select(*names, F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"))
    body = placed.where("copies > 0").select("conv", *[F.lit(None).cast("string" if c == "audit" else "bigint").alias(c) for c in names[1:]], "at", "role", "text", "copies")

    def digest(batches):
        """Rows stream by; only the current conversation's head and hash are kept."""
        head = None
        for batch in batches:
            out = []
            for values in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if values[8] < 0:
                    if head:
                        out.append((*head[0], head[1].finish()))
                    head = (values[:8], Repaired(values[7]))
                else:
                    for _ in range(values[11]):
                        head[1].row(values[9], values[10])
            yield from _as_batches([out] if out else [], [*done_kinds, ("repaired_sha256", pa.string())])
        yield from _as_batches([[(*head[0], head[1].finish())]] if head else [], [*done_kinds, ("repaired_sha256", pa.string())])

    return heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(
        digest, f"conv {conv_type}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")


class Repaired:
    """SHA-256 of the repaired ``role:text`` lines, fed row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.begun = audit, 0, START, hashlib.sha256(), False

    def _line(self, role: str, text: str, state: int):
        self.hash.update((("\n" if self.begun else "") + role + ":" + text).encode())
        self.begun, self.state = True, state

    def _inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            wanted = WANTED[self.state]
            self._line(ROLE_OF[wanted], "", AFTER[wanted][self.state])
            self.at += 1

    def row(self, role: str, text: str):
        self._inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._line(role, text, AFTER[role[0]][self.state])
        elif letter == "R":
            wanted = WANTED[self.state]
            self._line(ROLE_OF[wanted], text, AFTER[wanted][self.state])

    def finish(self) -> str:
        self._inserted()
        return self.hash.hexdigest()
