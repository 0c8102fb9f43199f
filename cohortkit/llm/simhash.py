"""SimHash fingerprints of 128 bits, in DataFrame functions only.

Terms are the words of the lower-case text (runs of letters and figures) and
the pairs of neighbouring words; a pair weighs twice a word.  Every
term's 128 hash bits vote, plus for a one, minus for a zero, and the sign of
the sum is the bit.  Votes are kept two to a number (bits j and j + 32 of a
hash, 32 binary digits each), so 64 sums of a generated aggregation hold
all 128; texts are exploded into terms and summed in the same stage, so only
one row of sums per text and task is shuffled.

``near`` finds every fingerprint within ``radius`` bits of the queries.  The 128
bits are cut into (``radius`` + 1) / (``flips`` + 1) blocks, so two fingerprints that
differ in at most ``radius`` bits differ in at most ``flips`` bits of one of them.
Each block is one permuted table, looked up by the query's block and, with one
flip, by all blocks one bit away.  A pair is taken only from its first such
block.  Equal fingerprints are one row with a count.  Blocks with more than
``chunk`` fingerprints are cut by a hash of the whole fingerprint, and their queries
go to every piece.

Defined cases: a null text is empty; a text without words has the zero
fingerprint; equal texts have equal fingerprints; repeated rows are returned as often as
they come; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BITS = 128
#: Seeds of the two 64-bit hashes of a term, mixed into it as a second value.
SEEDS = (11, 23)
PAIR_MASK = 0x0000000100000001
LOW = 0xFFFFFFFF
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Fingerprints of one block that a task compares at once.
CHUNK = 4096


def votes(rows: DataFrame, text_col: str, keys: list[str], word_weight: int = 1, pair_weight: int = 2) -> DataFrame:
    """Two fingerprint halves ``f0, f1`` for every distinct ``keys``, and ``n_rows`` that had them.
    Rows with equal keys must have equal texts: their votes only scale."""
    words = F.filter(F.split(F.lower(text_col), NOT_WORD, -1), lambda w: w != "")
    terms = rows.select(*keys, words.alias("_words")).select(*keys, "_words", F.posexplode_outer("_words").alias("_at", "_word"))
    after = F.get("_words", F.col("_at") + 1)
    sums = {}
    for k, seed in enumerate(SEEDS):
        single = F.xxhash64("_word", F.lit(seed))
        pair = F.xxhash64("_word", after, F.lit(seed))
        for j in range(32):
            one = lambda h: F.shiftrightunsigned(h, j).bitwiseAND(F.lit(PAIR_MASK))  # noqa: B023, E731
            sums[f"v{k}_{j}"] = F.sum(one(F.col(f"_h{k}")) * word_weight + F.when(F.col("_last"), F.lit(0)).otherwise(one(F.col(f"_p{k}")) * pair_weight))
        terms = terms.withColumns({f"_h{k}": F.when(F.col("_word").isNull(), F.lit(0)).otherwise(single), f"_p{k}": pair})
    terms = terms.withColumn("_last", after.isNull())
    weight = F.when(F.col("_word").isNull(), 0).otherwise(F.when(F.col("_last"), word_weight).otherwise(word_weight + pair_weight))
    added = terms.groupBy(*keys).agg(*[v.alias(n) for n, v in sums.items()], F.sum(weight).alias("_total"),
                                     F.sum(F.when(F.coalesce("_at", F.lit(0)) == 0, 1).otherwise(0)).alias("n_rows"))
    halves = []
    for k in range(len(SEEDS)):
        bits = []
        for j in range(32):
            lanes = F.col(f"v{k}_{j}")
            for shift, count in ((j, lanes.bitwiseAND(F.lit(LOW))), (j + 32, F.shiftrightunsigned(lanes, 32))):
                bits.append(F.when(2 * count > F.col("_total"), F.lit(1 << shift if shift < 63 else -(1 << 63))).otherwise(F.lit(0)))
        halves.append(reduce(Column.bitwiseOR, bits).alias(f"f{k}"))
    return added.select(*keys, *halves, "n_rows")


def as_text(a: str, b: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(a: tuple, b: tuple) -> Column:
    return F.bit_count(F.col(a[0]).bitwiseXOR(F.col(b[0]))) + F.bit_count(F.col(a[1]).bitwiseXOR(F.col(b[1])))


def likeness(a: tuple, b: tuple) -> Column:
    return 1 - distance(a, b) / BITS


def near(prints: DataFrame, queries: DataFrame, radius: int = 3, flips: int = 0, chunk: int = CHUNK) -> DataFrame:
    """``f0, f1, m0, m1, n`` : for every distinct fingerprint of ``queries``, every distinct one of
    ``prints`` within ``radius`` bits and how many rows have it."""
    n_blocks = (radius + 1) // (flips + 1)
    width = BITS // n_blocks if n_blocks else 0
    if flips not in (0, 1) or n_blocks * (flips + 1) != radius + 1 or not 1 <= width <= 64 or 64 % width:
        raise ValueError("flips is 0 or 1, and (radius + 1) / (flips + 1) a power of two from 2 to 64, so that blocks don't cross the halves")
    mask = F.lit((1 << width) - 1 if width < 64 else -1)
    per_half = 64 // width

    def cut(half, i):
        return F.shiftrightunsigned(half, i % per_half * width).bitwiseAND(mask)

    def tables(df, names):
        parts = F.array(*[F.struct(F.lit(i).alias("table"), cut(F.col(names[i // per_half]), i).alias("part")) for i in range(n_blocks)])
        return df.select("*", F.explode(parts).alias("_t")).select("*", "_t.table", "_t.part").drop("_t")

    all_prints = stored(prints.groupBy(F.col("f0").alias("m0"), F.col("f1").alias("m1")).agg(F.count(F.lit(1)).alias("n")), "simhash-prints")
    asked = stored(queries.select("f0", "f1").distinct(), "simhash-asked")
    data, probes = tables(all_prints, ("m0", "m1")), tables(asked, ("f0", "f1"))
    if flips:
        masks = [0, *[1 << b if b < 63 else -(1 << 63) for b in range(width)]]
        probes = probes.withColumn("_flip", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])))
        probes = probes.withColumn("part", F.col("part").bitwiseXOR(F.col("_flip"))).drop("_flip")
    hot = stored(data.groupBy("table", "part").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk)
                 .select("table", "part", F.ceil(F.col("_n") / chunk).cast("int").alias("_pieces")), "simhash-hot")
    if n_blocks << width <= 1 << 20:
        hot = F.broadcast(hot)  # at most n_blocks x 2 ** width rows of 16 bytes
    pieces = F.coalesce("_pieces", F.lit(1))
    data = data.join(hot, ["table", "part"], "left").withColumn("_piece", F.pmod(F.xxhash64("m0", "m1"), pieces).cast("int")).drop("_pieces")
    probes = probes.join(hot, ["table", "part"], "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces")
    halves = [F.col("f0").bitwiseXOR(F.col("m0")), F.col("f1").bitwiseXOR(F.col("m1"))]
    first = reduce(lambda a, b: a & b, [(F.col("table") <= i) | (F.bit_count(cut(halves[i // per_half], i)) > flips) for i in range(n_blocks)])
    # Sizes are estimated before the explosions: without the hint all probes would be broadcast.
    pairs = probes.join(data.hint("merge"), ["table", "part", "_piece"])
    return pairs.filter((distance(("f0", "f1"), ("m0", "m1")) <= radius) & first).select("f0", "f1", "m0", "m1", "n")


def next_ids(ids: DataFrame, width: int = 4096) -> DataFrame:
    """``id, next_id``: for each distinct integer ``id`` the largest smaller one, and for the smallest the largest.

    A window over blocks of ``width`` consecutive numbers links neighbours
    within a block; then the blocks are linked the same way, and so on, at
    most six times.  No task gets more than twice ``width`` distinct ids.
    """
    level = ids.select(F.col("id").alias("key")).filter("key IS NOT NULL").distinct().select("key", F.col("key").alias("lo"), F.col("key").alias("hi"))
    out = None
    while True:
        block = F.expr(f"key div {width}")
        step = stored(level.withColumn("block", block).withColumn("next_id", F.lag("hi").over(Window.partitionBy("block").orderBy("key"))), "simhash-order")
        linked = step.filter("next_id IS NOT NULL").select(F.col("lo").alias("id"), "next_id")
        out = linked if out is None else out.unionByName(linked)
        level = stored(step.groupBy(F.col("block").alias("key")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "simhash-blocks")
        if level.limit(2).count() < 2:
            return out.unionByName(level.select(F.col("lo").alias("id"), F.col("hi").alias("next_id")))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, edited, next_id, next_key`` per row: ``edited`` has the last third of the text
    replaced by as much of the start of the next document in descending order of id.

    ``next_key`` is a hash of the next document's text (of several rows with
    one id, the least text).  A row without an id has no next document.
    The texts are dealt out once, by id, and used for both sides.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = stored(rows.select("id", F.char_length("text").alias("n")).groupBy("id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")), "simhash-sizes")
    order = next_ids(sizes.select("id"))
    need = stored(order.join(sizes, "id").select(F.col("next_id").alias("id"), F.col("id").alias("to_id"), F.floor(F.col("n") / 3).cast("int").alias("k")), "simhash-need")
    repeated = sizes.filter("rows > 1 AND id IS NOT NULL").select("id")
    known = rows.filter("id IS NOT NULL")
    source = known
    if repeated.limit(1).count():
        least = known.join(repeated, "id").groupBy("id").agg(F.min("text").alias("text"))
        source = known.join(repeated, "id", "left_anti").unionByName(least)
    heads = source.join(need, "id").select(F.col("to_id").alias("id"), F.col("id").alias("next_id"), F.xxhash64("text").alias("next_key"),
                                           F.expr("left(text, k)").alias("head"))
    # Every id has a next one: an inner join, which reads the same exchange of (id, text) as the join above.
    alone = rows.filter("id IS NULL").withColumns({"next_id": F.lit(None).cast("bigint"), "next_key": F.lit(None).cast("bigint"), "head": F.lit("")})
    joined = known.join(heads, "id").unionByName(alone)
    edited = F.expr("concat(left(text, char_length(text) - cast(floor(char_length(text) / 3) AS int)), left(head, cast(floor(char_length(text) / 3) AS int)))")
    return joined.select("id", "text", edited.alias("edited"), "next_id", "next_key")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 15, query_step: int = 50) -> DataFrame:
    """Per row: fingerprints of the text, of its edit and their likeness, the likeness to the next
    document, and for ids divisible by ``query_step`` the number of rows within ``radius`` bits (itself included)."""
    both = with_edits(docs, id_col, text_col)
    both = both.withColumns({"n_chars": F.char_length("text").cast("bigint"), "text_key": F.xxhash64("text"), "edited_sha256": F.sha2("edited", 256)})
    keys = ["id", "n_chars", "text_key", "edited_sha256", "next_id", "next_key", "which"]
    two = both.select("*", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                                             F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("_e"))
    two = two.select(*keys[:-1], "_e.which", F.col("_e.t").alias("t"))
    halves = votes(two, "t", keys)
    pick = lambda c, w: F.max(F.when(F.col("which") == w, F.col(c)))
    prints = stored(halves.groupBy(*keys[:-1]).agg(pick("f0", 0).alias("f0"), pick("f1", 0).alias("f1"), pick("f0", 1).alias("e0"), pick("f1", 1).alias("e1"),
                                                   F.max("n_rows").alias("n_rows")), "simhash-fingerprints")
    prints = prints.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))).drop("row", "n_rows")
    nexts = prints.select(F.col("id").alias("next_id"), F.col("text_key").alias("next_key"), F.col("f0").alias("g0"), F.col("f1").alias("g1")).distinct()
    asked = prints.filter(F.col("id") % query_step == 0)
    counts = stored(near(prints, asked, radius, radius % 2).groupBy("f0", "f1").agg(F.sum("n").alias("n_near")), "simhash-near")
    out = prints.join(nexts, ["next_id", "next_key"], "left").join(counts, ["f0", "f1"], "left")
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text("f0", "f1").alias("fingerprint"), as_text("e0", "e1").alias("edited_fingerprint"),
        likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"), likeness(("f0", "f1"), ("g0", "g1")).alias("near_next"),
        F.when(F.col("id") % query_step == 0, F.col("n_near")).alias("n_near"))
