"""Order statistics that stay distributed.

Spark's exact ``percentile`` and an un-partitioned window both funnel a whole
group into one task.  The helpers here never do:

* ``prefix_sums``   exclusive running sums along a global order, computed in
  two levels (range partitions → per-partition totals → offsets).
* ``average_rank``  1-based average ranks with ties (Spearman, AUC).
* ``quantiles``     exact linear-interpolated quantiles by iterative
  selection: a mergeable sketch brackets each target rank, a count pass
  fixes the rank below the bracket, and only the few distinct values inside
  the bracket are ranked.  Memory per group is bounded by ``max_candidates``,
  whatever the group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.session import checkpoint_dir

_PID = "_ck_pid"


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def cut_by_range(df: DataFrame, order: Sequence[str], n: int, name: str = _PID, descending: bool = False) -> DataFrame:
    """``df`` dealt into ``n`` consecutive ranges of ``order`` (all columns, Spark's
    own order: nulls first and NaN last ascending), each row with its range
    number in ``name``.

    The ranges come from Spark's sample of the rows, so each holds about a
    1/n-th of them however many there are.  The sample may differ from run to
    run, so rows and numbers are kept in a reliable checkpoint that every
    consumer reads; rows equal in all order columns share a range.
    """
    checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(n, *_ordering(order, descending)).withColumn(name, F.spark_partition_id()).checkpoint(eager=True)


def _ordering(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(o).desc_nulls_last() if descending else F.col(o).asc_nulls_first() for o in order]


def prefix_sums(df: DataFrame, order: Sequence, weights: dict[str, Column] | None = None,
                by: Sequence[str] = (), num_partitions: int | None = None,
                inclusive: bool = False, descending: bool = False) -> DataFrame:
    """Add one running-sum column per ``weights`` entry (default: row index).

    Rows are ordered by the column names in ``order`` (all ascending, or
    all descending) inside each ``by`` group (null is a group); the sum is
    exclusive unless ``inclusive``.  Two levels: rows are cut into
    ``num_partitions`` ranges (``cut_by_range``), summed by a window over
    (group, range), and shifted by the totals of the ranges before.
    """
    weights = dict(weights or {"_ck_idx": F.lit(1)})
    by = list(by)
    n = _num_partitions(df, num_partitions)
    b = cut_by_range(df.select("*", *[w.alias(f"_ck_w_{k}") for k, w in weights.items()]), order, n, descending=descending)
    frame = Window.partitionBy(*by, _PID).orderBy(*_ordering(order, descending)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = b.select("*", *[F.sum(f"_ck_w_{k}").over(frame).alias(f"_ck_l_{k}") for k in weights])
    totals = b.groupBy(*by, _PID).agg(*[F.sum(f"_ck_w_{k}").alias(f"_ck_t_{k}") for k in weights])
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_ck_by_{i}") for i, c in enumerate(by)], F.col(_PID).alias("_ck_range"), *[
        F.coalesce(F.sum(f"_ck_t_{k}").over(before), F.lit(0)).alias(f"_ck_o_{k}") for k in weights])
    same = F.col(_PID) == F.col("_ck_range")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_ck_by_{i}"))
    # Without groups the offsets are one row per range: broadcast.  With
    # groups their number depends on the data, so the optimizer decides.
    joined = local.join(F.broadcast(offsets) if not by else offsets, same)
    exprs = []
    for k in weights:
        incl = F.col(f"_ck_o_{k}") + F.col(f"_ck_l_{k}")
        exprs.append((incl if inclusive else incl - F.col(f"_ck_w_{k}")).alias(k))
    return joined.select(*[F.col(c) for c in df.columns], *exprs)


def row_index(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "row_idx",
              num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row along ``order`` within ``by`` groups (null is a group).

    Rows are dealt once, into sorted ranges of (by, order): a row's place in its range plus the rows of the ranges
    before is its place among all, and the least place of its group is where the group begins.
    """
    by = list(by)
    checkpoint_dir(df.sparkSession)
    along = _ordering([*by, *order], False)
    # The number of a row: its partition above, its place in the partition in the lower 33 bits.
    placed = df.repartitionByRange(_num_partitions(df, num_partitions), *along).sortWithinPartitions(*along).withColumn(
        "_ck_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    part, place = F.shiftright("_ck_at", 33), F.col("_ck_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_ck_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = placed.groupBy(part.alias("_ck_range")).agg(F.count(F.lit(1)).alias("_ck_n")).select(
        "_ck_range", F.coalesce(F.sum("_ck_n").over(before), F.lit(0)).alias("_ck_before"))
    rows = placed.join(F.broadcast(offsets), part == F.col("_ck_range"))
    among = (F.col("_ck_before") + place).cast("bigint")
    if not by:
        return rows.select(*df.columns, among.alias(name))
    # One row per group, counted before the join: few groups are broadcast, many joined by key.
    begins = rows.groupBy(*[F.col(c).alias(f"_ck_by_{i}") for i, c in enumerate(by)]).agg(F.min(among).alias("_ck_begin")).checkpoint(eager=True)
    begins = F.broadcast(begins) if begins.count() <= 100_000 else begins
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_ck_by_{i}"))
    return rows.join(begins, same).select(*df.columns, (among - F.col("_ck_begin")).alias(name))


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank",
                 num_partitions: int | None = None) -> DataFrame:
    """Distinct ``(by, value)`` rows with the 1-based average rank of ``value``.

    Ties collapse in a partial aggregation first, so a value repeated a
    billion times is one row.  Nulls are not ranked.
    """
    d = (df.where(F.col(value).isNotNull())
         .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ck_ties")))
    d = prefix_sums(d, [value], {"_ck_before": F.col("_ck_ties")}, by, num_partitions)
    return d.select(*by, value, "_ck_ties",
                    (F.col("_ck_before") + (F.col("_ck_ties") + 1) / 2.0).alias(name))


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
         name: str = "column", value: str = "value") -> DataFrame:
    """Long form ``(by..., column, value)`` of numeric columns; drops null/NaN."""
    casted = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = casted.unpivot(list(by), list(cols), name, value)
    return long.where(F.col(value).isNotNull() & ~F.isnan(value))


def quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float],
              by: Sequence[str] = (), accuracy: int = 10000, max_candidates: int = 1_000_000,
              max_rounds: int = 6) -> DataFrame:
    """Exact quantiles (linear interpolation, as ``quantile_cont``).

    Returns ``(by..., column, <name> for each prob)``; one row per group
    and column that has at least one non-null value.

    Groups of at most ``max_candidates`` values use Spark's exact
    ``percentile`` (its buffer is then bounded by that constant).  Larger
    ("hot") groups -- or a whole column -- go through iterative selection,
    whose memory per group is bounded by ``max_candidates`` whatever the
    group size.
    """
    by = list(by)
    keys = by + ["column"]
    names = list(probs)
    if not by:
        # One pass counts every column; no limit, which would bring all rows to one task.
        sizes = df.agg(*[F.count(_number(c)).alias(f"_ck_n{i}") for i, c in enumerate(cols)]).first()
        large = [c for i, c in enumerate(cols) if sizes[i] > max_candidates]
        rest = [c for c in cols if c not in large]
        small = _small_table_exact(df, rest, probs) if rest or not large else None
        if not large:
            return small
        found = _selection(melt(df, large), keys, names, probs, by, accuracy, max_candidates, max_rounds)
        return found if small is None else small.unionByName(found)
    long = melt(df, cols, by)
    # At most rows / max_candidates groups are hot.
    checkpoint_dir(df.sparkSession)
    hot = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ck_n")).where(F.col("_ck_n") > max_candidates).select(*keys).checkpoint(eager=True)
    if hot.isEmpty():
        return _small_groups_exact(long, keys, probs)
    normal = long.join(F.broadcast(hot), keys, "left_anti")
    heavy = long.join(F.broadcast(hot), keys, "left_semi")
    return _small_groups_exact(normal, keys, probs).unionByName(
        _selection(heavy, keys, names, probs, by, accuracy, max_candidates, max_rounds))


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _small_table_exact(df: DataFrame, cols: list[str], probs: dict[str, float]) -> DataFrame:
    names = list(probs)
    pv = [float(probs[n]) for n in names]

    row = df.agg(*[F.percentile(_number(c), pv).alias(f"_ck_q{i}") for i, c in enumerate(cols)])
    # One row per column that has a value (as the grouped path returns).
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"_ck_q{i}")[j].alias(n) for j, n in enumerate(names)])
        for i, c in enumerate(cols)])).alias("r")).select("r.*").where(F.col(names[0]).isNotNull())


def _small_groups_exact(long: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    names = list(probs)
    g = long.groupBy(*keys).agg(
        F.percentile("value", [float(probs[n]) for n in names]).alias("_ck_q"))
    return g.select(*keys, *[F.col("_ck_q")[i].alias(n) for i, n in enumerate(names)])


def _selection(long, keys, names, probs, by, accuracy, max_candidates, max_rounds):
    eps = 1.0 / accuracy
    targets = [(i, float(probs[nm])) for i, nm in enumerate(names)]

    # Round 0: group sizes plus a bracket around every target rank.
    lo_p = [max(0.0, p - 2 * eps) for _, p in targets]
    hi_p = [min(1.0, p + 2 * eps) for _, p in targets]
    sk = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", F.array(*[F.lit(x) for x in lo_p + hi_p]), accuracy).alias("b"))
    k = len(targets)
    t = sk.select(*keys, "n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pi"), F.lit(p).alias("p"),
                 F.col("b")[i].alias("lo"), F.col("b")[k + i].alias("hi"))
        for i, p in targets])).alias("t")).select(*keys, "n", "t.*")
    pos = (F.col("n") - 1) * F.col("p")
    t = t.select(*keys, "pi", "n", F.floor(pos).cast("long").alias("r0"),
                 F.ceil(pos).cast("long").alias("r1"),
                 (pos - F.floor(pos)).alias("frac"), "lo", "hi")
    t = _count_bracket(long, t, keys, F.lit(float("-inf")), F.lit(0).cast("long"), by)
    t = t.checkpoint(eager=True)

    for _ in range(max_rounds):
        big = t.where(F.col("nd") > max_candidates)
        if big.isEmpty():
            break
        t = _refine(long, t, keys, by, eps, accuracy, max_candidates).checkpoint(eager=True)

    return _finalize(long, t, keys, names, by)


def _targets_join(long: DataFrame, t: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    # One row per hot group (or whole column) and prob: a join by key would bring a hot group to one task.
    return long.join(F.broadcast(t), keys)


def _count_bracket(long, t, keys, floor_lo, floor_below, by):
    """Add ``below`` (values < lo) and ``inb``/``nd`` (rows / distinct in [lo, hi]).

    A bracket that missed its target rank (possible only if the sketch
    broke its error bound) is reset to the whole range.
    """
    j = _targets_join(long, t, keys, by)
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    inside = (v >= lo) & (v <= hi)
    c = j.groupBy(*keys, "pi").agg(
        F.count_if(v < lo).alias("below"),
        F.count_if(inside).alias("inb"),
        F.approx_count_distinct(F.when(inside, v)).alias("nd"))
    t = t.join(c, keys + ["pi"], "left").fillna(0, ["below", "inb", "nd"])
    ok = (F.col("r0") >= F.col("below")) & (F.col("r1") < F.col("below") + F.col("inb"))
    whole = ~ok
    return t.select(
        *keys, "pi", "n", "r0", "r1", "frac",
        F.when(whole, floor_lo).otherwise(F.col("lo")).alias("lo"),
        F.when(whole, F.lit(float("inf"))).otherwise(F.col("hi")).alias("hi"),
        F.when(whole, floor_below).otherwise(F.col("below")).alias("below"),
        F.when(whole, F.col("n")).otherwise(F.col("inb")).alias("inb"),
        F.when(whole, F.col("n")).otherwise(F.col("nd")).alias("nd"))


def _refine(long, t, keys, by, eps, accuracy, max_candidates):
    """Narrow brackets that still hold too many distinct values."""
    done = t.where(F.col("nd") <= max_candidates)
    todo = t.where(F.col("nd") > max_candidates)
    j = _targets_join(long, todo, keys, by).where(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    span = F.greatest(F.col("inb") - 1, F.lit(1))
    q0 = (F.col("r0") - F.col("below")) / span
    q1 = (F.col("r1") - F.col("below")) / span
    # percentile_approx needs a foldable percentage, so sketch at a fixed
    # grid and pick the grid points around each target afterwards.
    grid = [i / 1000.0 for i in range(1001)]
    sk = j.groupBy(*keys, "pi").agg(
        F.percentile_approx("value", F.array(*[F.lit(g) for g in grid]), accuracy).alias("g"))
    nt = todo.join(sk, keys + ["pi"])
    i0 = F.floor(F.greatest(q0 - 2 * eps, F.lit(0.0)) * 1000).cast("int")
    i1 = F.ceil(F.least(q1 + 2 * eps, F.lit(1.0)) * 1000).cast("int")
    nt = nt.select(*keys, "pi", "n", "r0", "r1", "frac",
                   F.col("g")[i0].alias("lo"), F.col("g")[i1].alias("hi"),
                   F.col("lo").alias("_old_lo"), F.col("below").alias("_old_below"))
    # below = old below + values in [old lo, new lo)
    j2 = _targets_join(long, nt, keys, by)
    v = F.col("value")
    c = j2.groupBy(*keys, "pi").agg(
        F.count_if((v >= F.col("_old_lo")) & (v < F.col("lo"))).alias("_extra"),
        F.count_if((v >= F.col("lo")) & (v <= F.col("hi"))).alias("inb"),
        F.approx_count_distinct(F.when((v >= F.col("lo")) & (v <= F.col("hi")), v)).alias("nd"))
    nt = nt.join(c, keys + ["pi"], "left").fillna(0, ["_extra", "inb", "nd"])
    nt = nt.select(*keys, "pi", "n", "r0", "r1", "frac", "lo", "hi",
                   (F.col("_old_below") + F.col("_extra")).alias("below"), "inb", "nd")
    return done.unionByName(nt)


def _finalize(long, t, keys, names, by):
    j = _targets_join(long, t, keys, by).where(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    d = j.groupBy(*keys, "pi", "below", "r0", "r1", "frac", "value").agg(
        F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys, "pi").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("start", F.col("below") + F.sum("c").over(w) - F.col("c"))
    hit0 = (F.col("r0") >= F.col("start")) & (F.col("r0") < F.col("start") + F.col("c"))
    hit1 = (F.col("r1") >= F.col("start")) & (F.col("r1") < F.col("start") + F.col("c"))
    g = d.groupBy(*keys, "pi").agg(
        F.max(F.when(hit0, F.col("value"))).alias("v0"),
        F.max(F.when(hit1, F.col("value"))).alias("v1"),
        F.first("frac").alias("frac"))
    g = g.select(*keys, "pi", (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")).alias("q"))
    return g.groupBy(*keys).agg(*[
        F.max(F.when(F.col("pi") == i, F.col("q"))).alias(nm) for i, nm in enumerate(names)])


def quantile_values(df: DataFrame, cols: Sequence[str], probs: dict[str, float], **kw) -> dict:
    """``{column: {name: value}}`` for global quantiles (bounded: cols × probs)."""
    out = {c: {nm: None for nm in probs} for c in cols}
    for r in quantiles(df, cols, probs, **kw).collect():
        out[r["column"]] = {nm: r[nm] for nm in probs}
    return out
