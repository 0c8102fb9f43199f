"""Descriptive statistics, tests, correlation and selection
(A02, A07–A10, A12, A14, A15, R01–R07).

Every statistic is a built-in aggregate or a short expression over one;
multi-column statistics are computed in one pass of conditional aggregates
and unpivoted to a tidy ``(column, …)`` table.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.distributions import chi2_pvalue_udf, t_pvalue_udf
from cohortkit.functions.ordered import average_rank, melt, prefix_sums, quantiles
from cohortkit.operators.joins import broadcast_if_small
from cohortkit.session import checkpoint_dir

MAX_AGG_EXPRS = 500


def _tidy(wide: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row ``{col}__{field}`` aggregate → rows ``(column, field...)``."""
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in cols
    ])).alias("r")).select("r.*")


def distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, population std, min, max per column (nulls skipped)."""
    cols = list(cols)
    wide = df.agg(*[e for c in cols for e in (
        F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
    return _tidy(wide, cols, ["mean", "std", "min", "max"])


def stability_metrics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, sample std, biased skewness, biased excess kurtosis,
    missing ratio per column."""
    cols = list(cols)
    wide = df.agg(*[e for c in cols for e in (
        F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.skewness(c).alias(f"{c}__skew"), F.kurtosis(c).alias(f"{c}__kurtosis"),
        F.avg(F.col(c).isNull().cast("double")).alias(f"{c}__missing_ratio"))])
    return _tidy(wide, cols, ["mean", "std", "skew", "kurtosis", "missing_ratio"])


def cluster_stats(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Per cluster and column: mean, sample std, cluster size."""
    cols = list(cols)
    g = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), *[e for c in cols for e in (
        F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"))])
    return g.select(cluster, "size", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in cols])).alias("r")).select(cluster, "r.column", "r.mean", "r.std", "size")


def contingency(df: DataFrame, col: str, target: str) -> DataFrame:
    """Long-form crosstab ``(value, target, count)``; NULLs dropped."""
    d = df.where(F.col(col).isNotNull() & F.col(target).isNotNull())
    return d.groupBy(F.col(col).alias("value"), F.col(target).alias("target")).agg(
        F.count(F.lit(1)).alias("count"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """A10: ``(label, count, weight)`` with weight = n / (k · n_label)."""
    c = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count"))
    tot = c.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k"))
    # tot is one row: an inner join on a constant key keeps it a broadcast.
    j = c.withColumn("_ck", F.lit(1)).join(F.broadcast(tot.withColumn("_ck", F.lit(1))), "_ck")
    return j.select("label", "count", (F.col("n") / (F.col("k") * F.col("count"))).alias("weight"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A12."""
    return df.select(col).distinct()


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Exact equal-width histogram over all rows (no sampling):
    ``(column, bin, bin_lo, bin_hi, count, density)``; the maximum falls
    in the last bin; density = count / (n · width)."""
    long = melt(df, cols)
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                     F.count(F.lit(1)).alias("n"))
    j = long.join(F.broadcast(rng), "column")  # one row per column
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    g = j.groupBy("column", b.cast("int").alias("bin"), "lo", "hi", "n").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("hi") - F.col("lo")) / bins
    return g.select("column", "bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "count",
                    F.when(w > 0, F.col("count") / (F.col("n") * w)).alias("density"))


def box_stats(df: DataFrame, cols: Sequence[str], target: str, k: float = 1.5) -> DataFrame:
    """Per target value and column: quartiles, median, whiskers
    (furthest values within k·IQR) and the number of outliers."""
    long = melt(df.where(F.col(target).isNotNull()), cols, by=[target])
    q = quantiles(long.select(target, "column", "value").withColumnRenamed("column", "_ck_col"),
                  ["value"], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[target, "_ck_col"]).drop("column")
    # Targets × columns rows: broadcast where their number, counted first, is small; joined by key a target would be one task's.
    checkpoint_dir(df.sparkSession)
    q = broadcast_if_small(q.withColumnRenamed("_ck_col", "column").checkpoint(eager=True), 100_000)
    j = long.join(q, [target, "column"])
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - k * iqr, F.col("q3") + k * iqr
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy(target, "column", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def box_outliers(df: DataFrame, cols: Sequence[str], target: str, k: float = 1.5,
                 keep: Sequence[str] = ()) -> DataFrame:
    """A15 outlier points: rows outside [q1 − k·IQR, q3 + k·IQR] of their
    target group, as ``(target, column, value, keep…)``."""
    long = melt(df.where(F.col(target).isNotNull()), cols, by=[target, *keep])
    q = quantiles(long.select(target, "column", "value").withColumnRenamed("column", "_ck_col"),
                  ["value"], {"q1": 0.25, "q3": 0.75}, by=[target, "_ck_col"]).drop("column")
    checkpoint_dir(df.sparkSession)
    q = broadcast_if_small(q.withColumnRenamed("_ck_col", "column").checkpoint(eager=True), 100_000)
    j = long.join(q, [target, "column"])
    iqr = F.col("q3") - F.col("q1")
    out = (F.col("value") < F.col("q1") - k * iqr) | (F.col("value") > F.col("q3") + k * iqr)
    return j.where(out).select(target, "column", "value", *keep)


# --- correlation -------------------------------------------------------------

def safe_corr(a: str, b: str):
    """Pearson correlation over rows where both values are present; NULL
    (not an ANSI divide-by-zero error) when either column is constant."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    xa, ya = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xa, ya), F.stddev_samp(xa) * F.stddev_samp(ya))


def _pairwise_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cols = list(cols)
    pairs = list(itertools.combinations(range(len(cols)), 2))
    parts = []
    for s in range(0, max(len(pairs), 1), MAX_AGG_EXPRS):
        chunk = pairs[s:s + MAX_AGG_EXPRS]
        if not chunk:
            break
        wide = df.agg(*[safe_corr(cols[i], cols[j]).alias(f"p{i}_{j}") for i, j in chunk])
        parts.append(wide.select(F.explode(F.array(*[
            F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), F.col(f"p{i}_{j}").alias("r"))
            for i, j in chunk])).alias("x")).select("x.*"))
    upper = parts[0]
    for p in parts[1:]:
        upper = upper.unionByName(p)
    lower = upper.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    return upper.unionByName(lower).unionByName(diag)


def rank_columns(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace each column by its average rank (ties averaged).  One
    ranking job for all columns (long form, grouped by column); each
    column's table of distinct values and ranks is joined back."""
    ranks = average_rank(melt(df, cols), "value", by=["column"], name="rank")
    out = df
    for c in cols:
        r = ranks.where(F.col("column") == c).select(F.col("value").alias(f"_ck_v_{c}"),
                                                     F.col("rank").alias(f"_ck_r_{c}"))
        out = out.join(r, F.col(c).cast("double") == F.col(f"_ck_v_{c}"), "left").drop(f"_ck_v_{c}")
    return out.select(*[F.col(f"_ck_r_{c}").alias(c + suffix) if c in set(cols) else F.col(c)
                        for c in df.columns])


def pairwise_ranks(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Average ranks of every column over the rows that it shares with each partner.

    Returns one row per row of ``df`` with a map ``ranks``, column to array, and the slot of each partner in these arrays: slot 0 is the rank over all
    rows that have the column, which also serves partners without missing values; every other partner has its own slot.
    A value's rank among the rows that also have b is the number of these rows below it plus half of those
    at it, so one order of a column's distinct values with a running count per partner gives them all.
    """
    cols = list(cols)
    clean = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
    missing = clean.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    partners = [c for c in cols if missing[c]]
    slots = {c: partners.index(c) + 1 if missing[c] else 0 for c in cols}
    have = F.array(F.lit(1), *[F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in partners])
    rows = clean.select("*", have.alias("_ck_have"), F.monotonically_increasing_id().alias("_ck_row")).checkpoint(eager=True)
    long = melt(rows, cols, by=["_ck_row", "_ck_have"])
    counts = long.groupBy("column", "value").agg(*[F.sum(F.col("_ck_have")[i]).alias(f"_ck_c{i}") for i in range(len(partners) + 1)])
    below = prefix_sums(counts, ["column", "value"], {f"_ck_b{i}": F.col(f"_ck_c{i}") for i in range(len(partners) + 1)}, by=["column"])
    ranks = below.select("column", "value", F.array(*[F.col(f"_ck_b{i}") + (F.col(f"_ck_c{i}") + 1) / 2.0 for i in range(len(partners) + 1)]).alias("ranks"))
    each = long.select("_ck_row", "column", "value").join(ranks, ["column", "value"]).groupBy("_ck_row").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "ranks"))).alias("ranks"))  # at most one entry per column
    return each, slots


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Spearman correlation, Pearson of the ranks that both columns have over their common rows."""
    cols = list(cols)
    each, slots = pairwise_ranks(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    out = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    for at in range(0, len(pairs), 200):
        part = pairs[at:at + 200]
        ranked = each.select(*[F.col("ranks")[x][slots[y]].alias(f"_ck_{s}{i}") for i, (a, b) in enumerate(part) for s, x, y in (("a", a, b), ("b", b, a))])
        one = ranked.agg(*[safe_corr(f"_ck_a{i}", f"_ck_b{i}").alias(f"r{i}") for i in range(len(part))])
        out = out.unionByName(one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"r{i}").alias("r"))
                                                             for i, (a, b) in enumerate(part) for x, y in ((a, b), (b, a))])).alias("p")).select("p.*"))
    return out


def corr_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """Long-form matrix ``(col_a, col_b, r)`` incl. both orders and
    the diagonal, over the rows that both columns of a pair have."""
    if method == "spearman":
        return spearman_matrix(df, cols)
    if method != "pearson":
        raise ValueError(method)
    return _pairwise_corr(df, cols)


def high_correlation_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Pairs (both orders, no diagonal) with |r| > threshold."""
    m = _pairwise_corr(df, cols)
    return m.where((F.col("col_a") != F.col("col_b")) & (F.abs("r") > threshold))


def target_correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """R05 scores: ``(feature, abs_corr)`` = |Pearson(col, target)|."""
    cols = [c for c in cols if c != target]
    wide = df.agg(*[F.abs(safe_corr(c, target)).alias(f"{c}__abs_corr") for c in cols])
    return _tidy(wide, cols, ["abs_corr"]).withColumnRenamed("column", "feature")


def select_features(df: DataFrame, target: str, cols: Sequence[str], k: int = 30) -> tuple[DataFrame, list[str]]:
    """Keep the k columns most correlated with the target (ties by
    name; NaN correlations last).  The target is never among the features."""
    from cohortkit.operators.select import top_k
    scores = target_correlation(df, target, cols).withColumn(
        "abs_corr", F.when(F.isnan("abs_corr"), None).otherwise(F.col("abs_corr")))
    names = [r["feature"] for r in top_k(scores, "abs_corr", k, ["feature"]).collect()]
    return df.select(*names, target), names


# --- tests by binary target ----------------------------------------------------

def welch_tests(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Welch t statistic, Welch–Satterthwaite dof, two-sided p, and
    Cohen's d = (m1 − m0)/sqrt((v1 + v0)/2), group 1 first.  One pass."""
    cols = [c for c in cols if c != target]
    t = F.col(target)
    aggs = []
    for c in cols:
        for g in (1, 0):
            v = F.when(t == g, F.col(c))
            aggs += [F.count(v).alias(f"{c}__n{g}"), F.avg(v).alias(f"{c}__m{g}"),
                     F.var_samp(v).alias(f"{c}__v{g}")]
    long = _tidy(df.agg(*aggs), cols, ["n1", "m1", "v1", "n0", "m0", "v0"])
    se1, se0 = F.try_divide(F.col("v1"), F.col("n1")), F.try_divide(F.col("v0"), F.col("n0"))
    tstat = F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(se1 + se0))
    dof = F.try_divide((se1 + se0) ** 2, F.try_divide(se1 ** 2, F.col("n1") - 1) + F.try_divide(se0 ** 2, F.col("n0") - 1))
    out = long.select("column", F.col("n1").alias("n_pos"), F.col("n0").alias("n_neg"),
                      F.col("m1").alias("mean_pos"), F.col("m0").alias("mean_neg"),
                      tstat.alias("t_stat"), dof.alias("dof"),
                      F.try_divide(F.col("m1") - F.col("m0"), F.sqrt((F.col("v1") + F.col("v0")) / 2)).alias("cohens_d"))
    return out.withColumn("p_value", t_pvalue_udf(F.col("t_stat"), F.col("dof")))


def chi2_tests(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Chi-square test of independence of each categorical column and a
    0/1 target (Yates correction when dof = 1) and Cramér's V.

    Cells come from conditional counts per category, so empty cells are
    zeros, with no cross join of categories and targets.
    """
    cols = [c for c in cols if c != target]
    d = df.where(F.col(target).isNotNull())
    long = (d.select(F.col(target).alias("_ck_t"), *[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot(["_ck_t"], cols, "column", "value").where(F.col("value").isNotNull()))
    cells = long.groupBy("column", "value").agg(F.count_if(F.col("_ck_t") == 0).alias("o0"),
                                                F.count_if(F.col("_ck_t") == 1).alias("o1"))
    tot = cells.groupBy("column").agg(F.sum("o0").alias("c0"), F.sum("o1").alias("c1"),
                                      F.count(F.lit(1)).alias("r"))
    j = cells.join(tot, "column")
    n = F.col("c0") + F.col("c1")
    ncols = (F.col("c0") > 0).cast("int") + (F.col("c1") > 0).cast("int")
    dof = (F.col("r") - 1) * (ncols - 1)
    ri = F.col("o0") + F.col("o1")

    def term(o, cj):
        e = ri * F.col(cj) / n
        diff = F.abs(F.col(o) - e)
        adj = F.when(dof == 1, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
        return F.when(e > 0, (diff - adj) ** 2 / e).otherwise(F.lit(0.0))

    g = j.groupBy("column").agg(F.sum(term("o0", "c0") + term("o1", "c1")).alias("chi2"),
                                F.first(dof).alias("dof"), F.first(n).alias("n"),
                                F.first(F.least(F.col("r"), ncols)).alias("min_dim"))
    out = g.select("column", "chi2", F.col("dof").cast("long").alias("dof"),
                   F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.col("min_dim") - 1))).alias("cramers_v"))
    return out.withColumn("p_value", chi2_pvalue_udf(F.col("chi2"), F.col("dof").cast("double")))


def mutual_information(df: DataFrame, target: str, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """R07 (re-aimed): mutual information (nats) between each column, cut
    into ``bins`` equal-width bins, and a discrete target:
    Σ p(x,y) · ln(p(x,y) / (p(x) p(y))).  ``(feature, mutual_info)``."""
    cols = [c for c in cols if c != target]
    long = melt(df.where(F.col(target).isNotNull()), cols, by=[target])
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(F.broadcast(rng), "column")
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    cnt = j.groupBy("column", b.alias("bin"), F.col(target).alias("y")).agg(F.count(F.lit(1)).alias("nxy"))
    nx = cnt.groupBy("column", "bin").agg(F.sum("nxy").alias("nx"))
    ny = cnt.groupBy("column", "y").agg(F.sum("nxy").alias("ny"))
    nn = cnt.groupBy("column").agg(F.sum("nxy").alias("n"))
    t = cnt.join(nx, ["column", "bin"]).join(ny, ["column", "y"]).join(nn, "column")
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return t.groupBy(F.col("column").alias("feature")).agg(F.sum(term).alias("mutual_info"))
