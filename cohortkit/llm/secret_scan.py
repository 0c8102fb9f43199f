"""Incremental secret scan over a blob ledger, in DataFrame functions only.

Every historical version of every path is addressed by the SHA-256 of its
text.  The ledger holds two tables: ``scanned`` (digest, rule, rule_version)
and ``findings`` (digest, rule, rule_version, kind_no, start, stop).  A scan
reads the text of one version per digest whose (digest, rule, version) pair
the ledger lacks, appends what it finds and joins all findings back to all
paths.  A changed rule gets a new version and is the only one rescanned.

Spans are code points, end exclusive, of whole matches.  Positions come from
the lengths of the pieces between matches (``split``) and of the matches
(``regexp_extract_all``), summed in a window per blob and rule; only blobs that a
cheap test of the rule passes get there.

Later scans test no text whose digest is known: a table of at most ``SLOTS`` numbers, taken from the
unseen digests, is joined first, and the test of a text asks for its match.  A rule with nothing unseen is passed over.

Shuffles: digests with one id each; the text of first versions once; the few
findings.  Copies never leave their scan, and a digest that a third of all
paths share skews only the small (path, digest) side of the last join, which
adaptive execution splits.

Defined cases: a null text is empty and has no findings; a null path is kept;
repeated rows are each returned; findings written twice after a broken run
are counted once; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import exists, free_name, id_key, new_dir, stored


@dataclass(frozen=True)
class Rule:
    """``pattern``: Java regex, leftmost non-overlapping.  A match counts if
    ``group`` of it has ``min_chars`` characters.  ``test``: a cheaper regex
    that every text with a finding matches."""
    name: str
    version: int
    pattern: str
    group: int
    min_chars: int
    test: str


#: The patterns of the three base kinds, in their order.  A run of hex digits or
#: of key characters is matched only at its full length, as the greedy base patterns do.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", 1, ASSIGN, 2, 12, ASSIGN[:-2] + "{12,})"),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
)

#: Numbers that unseen digests are hashed to.  With many more unseen digests most texts are tested, with the same findings.
SLOTS = 1 << 20


def _any_test(text, rules):
    """Whether ``text`` passes the test of any of ``rules``."""
    out = text.rlike(rules[0].test)
    for r in rules[1:]:
        out = out | text.rlike(r.test)
    return out


def _maybe_unseen(versions: DataFrame, todo: DataFrame, test) -> DataFrame:
    """``versions`` whose digest may be in ``todo`` and whose text passes ``test``, which no other text is put to:
    it hangs on a stored column of the joined table, so the optimizer can't move it below the join."""
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS))
    slots = stored(todo.select(slot.alias("slot")).distinct().withColumn("unseen", F.lit(True)), "secret-slots")
    return versions.withColumn("slot", slot).join(F.broadcast(slots), "slot").filter(F.when(F.col("unseen"), test)).drop("slot", "unseen")


def _spans(blobs: DataFrame, rule: Rule, number: int) -> DataFrame:
    """(digest, rule, rule_version, kind_no, start, stop) of one rule over ``blobs`` (digest, text)."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.transform(F.split("text", rule.pattern, -1), F.char_length).alias("gap"),
        F.transform(F.regexp_extract_all("text", pattern, 0), F.char_length).alias("match"),
        F.transform(F.regexp_extract_all("text", pattern, rule.group), F.char_length).alias("checked"))
    pieces = (blobs.filter(F.col("text").rlike(rule.test))
              .select("digest", F.posexplode(parts).alias("i", "p"))
              .select("digest", "i", "p.gap", "p.match", "p.checked"))
    before = Window.partitionBy("digest").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap").cast("bigint") + F.coalesce("match", F.lit(0))).over(before)
    return (pieces.withColumn("stop", stop).filter(F.col("checked") >= rule.min_chars)
            .select("digest", F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("rule_version"), F.lit(number).alias("kind_no"),
                    (F.col("stop") - F.col("match")).alias("start"), "stop"))


def scan(history: DataFrame, ledger: str, path_col: str = "path", text_col: str = "text", rules=RULES) -> DataFrame:
    """Scan what the ledger lacks, then return one row per version:
    ``path, digest, spans`` with spans an array of (start, kind_no, stop, rule)."""
    spark = history.sparkSession
    versions = history.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    versions = versions.withColumns({"digest": F.sha2("text", 256), "row_key": id_key("path")})
    paths = stored(versions.select("path", "digest"), "secret-paths")
    one = paths.groupBy("digest").agg(F.min(id_key("path")).alias("row_key"))
    known = spark.read.parquet(f"{ledger}/scanned") if exists(spark, f"{ledger}/scanned") else None
    for number, rule in _unseen_groups(rules, known is None):
        todo = one
        if known is not None:
            seen = known.filter((F.col("rule") == rule[0].name) & (F.col("rule_version") == rule[0].version)).select("digest").distinct()
            todo = one.join(seen, "digest", "left_anti")
        todo = stored(todo, "secret-todo")
        if known is not None and todo.isEmpty():
            continue
        # Shuffled-hash: the two short columns are built, the texts stream past unsorted.
        any_test = _any_test(F.col("text"), rule)
        texts = versions.select("digest", "row_key", "text")
        texts = texts.filter(any_test) if known is None else _maybe_unseen(texts, todo, any_test)
        blobs = (texts.join(todo.hint("shuffle_hash"), ["digest", "row_key"])
                 .select("digest", "text").dropDuplicates(["digest"]))
        blobs = stored(blobs, "secret-blobs")
        found = None
        for k, r in enumerate(rule):
            part = _spans(blobs, r, number + k)
            found = part if found is None else found.unionByName(part)
        found.write.mode("append").parquet(f"{ledger}/findings")
        for r in rule:
            (todo.select("digest", F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"))
             .write.mode("append").parquet(f"{ledger}/scanned"))
    want = None
    for r in rules:
        hit = (F.col("rule") == r.name) & (F.col("rule_version") == r.version)
        want = hit if want is None else want | hit
    spans = (spark.read.parquet(f"{ledger}/findings").filter(want).distinct().groupBy("digest")
             .agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "stop", "rule"))).alias("spans")))
    spans = stored(spans, "secret-spans")
    return paths.join(spans, "digest", "left").select("path", "digest", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def _unseen_groups(rules, fresh: bool):
    """Rules that share a scan: all of them on a new ledger, else each by itself, since each lacks other blobs."""
    return [(0, list(rules))] if fresh else [(i, [r]) for i, r in enumerate(rules)]


def span_text(spans: str):
    """``kind:start:end`` of the spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping and touching
    spans by one).  All rows and columns stay; texts without findings are unchanged.

    Spans that start at or before the largest end so far belong to one cut; the cuts of a text
    are found in a window over its spans.
    """
    found = scan(docs, ledger or new_dir(docs.sparkSession, "ledger"), id_col, text_col)
    spans = found.filter(F.size("spans") > 0).select("digest", "spans").dropDuplicates(["digest"]).select("digest", F.explode("spans").alias("s")).select("digest", "s.start", "s.stop")
    by = Window.partitionBy("digest").orderBy("start", "stop")
    spans = spans.withColumn("reach", F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("cut", F.sum(F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cuts = spans.groupBy("digest", "cut").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    digest, cut_list = free_name(docs, "_digest"), free_name(docs, "_cuts")
    few = stored(cuts.groupBy(F.col("digest").alias(digest)).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(cut_list)), "secret-cuts")
    at, text = F.col(cut_list), F.col(f"`{text_col}`")
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["stop"])
    pieces = F.transform(at, lambda c, i: F.concat(F.substring(text, (before(i) + 1).cast("int"), (c["start"] - before(i)).cast("int")), F.lit(mark)))
    tail = F.substring(text, (F.element_at(at, -1)["stop"] + 1).cast("int"), F.char_length(text))
    # Only texts that pass a rule's test can have cuts; the others stay in their tasks.
    tested = _any_test(F.coalesce(text, F.lit("")), RULES)
    out = docs.filter(tested).withColumn(digest, F.sha2(F.coalesce(text, F.lit("")), 256)).join(few, digest, "left")
    out = out.withColumn(text_col, F.when(at.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail)))
    same = docs.filter(~tested).withColumn(text_col, text)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns]).union(same)
