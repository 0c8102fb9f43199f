"""Projections, filters, casts (P01–P14), order/sample (O01–O08), set ops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.ordered import row_index

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# --- P01 / P02 / P03: column selection ------------------------------------

def columns_of_kind(df: DataFrame, kind: str = "numeric", exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric / string / temporal / boolean columns, in schema order."""
    def ok(dt):
        if kind == "numeric":
            return isinstance(dt, NUMERIC_TYPES)
        if kind == "string":
            return isinstance(dt, T.StringType)
        if kind == "temporal":
            return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))
        if kind == "boolean":
            return isinstance(dt, T.BooleanType)
        raise ValueError(kind)
    return [f.name for f in df.schema.fields if ok(f.dataType) and f.name not in set(exclude)]


def select_kind(df: DataFrame, kind: str = "numeric") -> DataFrame:
    return df.select(*columns_of_kind(df, kind))


def select_by_substring(df: DataFrame, sub: str) -> list[str]:
    """Columns whose lower-cased name contains ``sub``."""
    return [c for c in df.columns if sub.lower() in c.lower()]


# Upper-case name fragments that mark identifier and time columns.
ID_PATTERNS = ["ID", "_id", "TIME", "DATE", "ADMIT", "DISCH", "DEATH", "SUBJECT", "HADM", "ICUSTAY", "ROW"]


def feature_columns(df: DataFrame, target: str | None = None, patterns: Sequence[str] = ID_PATTERNS) -> list[str]:
    """Columns kept as model features: not matching any identifier
    pattern (tested on the upper-cased name), and never the target."""
    pats = [p.upper() for p in patterns]
    return [c for c in df.columns if not any(p in c.upper() for p in pats)
            and (target is None or c != target)]


def extract_features(df: DataFrame, target: str | None = None, patterns: Sequence[str] = ID_PATTERNS) -> DataFrame:
    return df.select(*feature_columns(df, target, patterns))


# --- P05–P09: row filters and casts ---------------------------------------

def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P05."""
    return df.na.drop(subset=list(keys))


def drop_any_null(df: DataFrame) -> DataFrame:
    """P06 (also S04's load rule).  NaN counts as missing, as in pandas."""
    cond = F.lit(True)
    for f in df.schema.fields:
        c = F.col(f.name).isNotNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c & ~F.isnan(f.name)
        cond = cond & c
    return df.where(cond)


def clean_float(c: Column) -> Column:
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and ±Infinity become NULL in float/double columns."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    todo = set(fl if cols is None else [c for c in cols if c in fl])
    return df.select(*[clean_float(F.col(c)).alias(c) if c in todo else F.col(c) for c in df.columns])


def cast_columns(df: DataFrame, cols: Sequence[str], to: str = "bigint") -> DataFrame:
    """P08."""
    s = set(cols)
    return df.select(*[F.col(c).cast(to).alias(c) if c in s else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text → double, unparseable → NULL (``to_numeric(errors='coerce')``)."""
    s = set(cols)
    return df.select(*[F.trim(F.col(c).cast("string")).try_cast("double").alias(c) if c in s else F.col(c)
                       for c in df.columns])


def category_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """P09 fallback: integer codes 0..k-1 by sorted distinct value (nulls → -1).

    The distinct values are ranked by the distributed ``row_index``; the
    code table (one row per category) joins back.
    """
    name = name or col
    d = df.select(F.col(col).alias("_ck_v")).where(F.col("_ck_v").isNotNull()).distinct()
    codes = row_index(d, ["_ck_v"], name="_ck_code")
    j = df.join(codes, F.col(col).eqNullSafe(F.col("_ck_v")), "left")
    return j.select(*[F.col(c) for c in df.columns if c != name],
                    F.coalesce(F.col("_ck_code"), F.lit(-1)).cast("int").alias(name))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10."""
    return df.drop(*cols)


def remap_binary_label(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Two distinct labels → 0 (smaller) / 1 (larger).  Raises unless
    exactly two non-null labels exist (checked on ≤ 3 distinct rows)."""
    vals = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(3).collect())
    if len(vals) != 2:
        raise ValueError(f"{col}: expected 2 labels, found {vals}")
    name = name or col
    lab = F.when(F.col(col) == F.lit(vals[0]), 0).when(F.col(col) == F.lit(vals[1]), 1).cast("int")
    return df.select(*[F.col(c) for c in df.columns if c != name], lab.alias(name))


def class_means(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Per column the mean among target = 1 and target = 0, in one pass
    of conditional aggregates (no filtered re-scans)."""
    t = F.col(target)
    aggs = []
    for c in cols:
        aggs += [F.avg(F.when(t == 1, F.col(c))).alias(f"{c}__1"), F.avg(F.when(t == 0, F.col(c))).alias(f"{c}__0")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__1").alias("mean_pos"), F.col(f"{c}__0").alias("mean_neg"))
        for c in cols])).alias("r")).select("r.*")


def add_prefix(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """P13."""
    s = set(df.columns if cols is None else cols)
    return df.select(*[F.col(c).alias(prefix + c) if c in s else F.col(c) for c in df.columns])


def ascii_fold(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast to text and strip every non-ASCII character."""
    s = set(df.columns if cols is None else cols)
    return df.select(*[F.regexp_replace(F.col(c).cast("string"), r"[^\x00-\x7F]", "").alias(c) if c in s
                       else F.col(c) for c in df.columns])


# --- O01–O08: order, top-k, sampling, splits ---------------------------------

def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """K rows with the largest (or smallest) ``by``; ties by
    ``tie`` ascending.  Planned as TakeOrderedAndProject: each task keeps k
    rows, one final task merges partitions × k rows."""
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(o, *[F.col(t).asc() for t in tie]).limit(k)


def hash_key(key: Sequence[str], seed: int) -> Column:
    """Seeded order key: hex MD5 of ``seed|k1|k2…``.  Independent of the
    partitioning, and reproducible in any SQL engine with ``md5``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_uniform(key: Sequence[str], seed: int) -> Column:
    """Deterministic U[0,1) from the row key (independent of partitioning)."""
    return (F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(1 << 53)).cast("double")
            / float(1 << 53))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """N rows without replacement, chosen by hash order of the key
    (reproducible whatever the partitioning)."""
    return df.orderBy(hash_key(key, seed), *[F.col(k) for k in key]).limit(n)


def sample_fraction(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """O05, approximate size: keep a row when its hash falls below ``fraction``."""
    return df.where(hash_uniform(key, seed) < fraction)


def md5_uniform(cols: Sequence, seed: int) -> Column:
    """U[0,1) from the first 52 bits of MD5(``seed|c1|c2…``): reproducible
    in any engine that has ``md5``."""
    txt = F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(txt), 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def poisson1_cdf(kmax: int = 16) -> list[float]:
    import math
    return [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(kmax)]


def _poisson1(u: Column, kmax: int = 16) -> Column:
    """Inverse CDF of Poisson(1) on a uniform ``u``."""
    expr = F.lit(kmax)
    cdf = poisson1_cdf(kmax)
    for k in reversed(range(kmax)):
        expr = F.when(u < cdf[k], F.lit(k)).otherwise(expr)
    return expr


def bootstrap(df: DataFrame, replicates: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Poisson bootstrap.  Each row gets a weight ~ Poisson(1) per
    replicate (``replicate``, ``weight``); zero-weight rows are dropped.
    Equivalent in distribution to resampling n rows with replacement, with
    no global coordination."""
    reps = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")
    e = df.select("*", reps)
    u = md5_uniform(["replicate", *key], seed)
    return e.withColumn("weight", _poisson1(u)).where(F.col("weight") > 0)


def stratified_split(df: DataFrame, label: str, key: Sequence[str], train_fraction: float = 0.8,
                     seed: int = 42, name: str = "split") -> DataFrame:
    """Exact stratified split.  Within each label rows are ranked by a
    seeded hash of the key (two-level distributed rank); the first
    round(train_fraction · n_label) go to ``train``, the rest to ``test``."""
    h = df.withColumn("_ck_h", F.unhex(hash_key(key, seed)))  # ordered as the hex text, in half the bytes
    r = row_index(h, ["_ck_h", *key], by=[label], name="_ck_i")
    sizes = df.groupBy(F.col(label).alias("_ck_lab")).agg(F.count(F.lit(1)).alias("_ck_n"))
    # One row per label value (NULL included, matched null-safe).
    j = r.join(F.broadcast(sizes), r[label].eqNullSafe(sizes["_ck_lab"]))
    cut = F.floor(F.col("_ck_n") * train_fraction + 0.5)
    return j.select(*[F.col(c) for c in df.columns],
                    F.when(F.col("_ck_i") < cut, "train").otherwise("test").alias(name))


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], k: int = 3, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """fold = (hash rank within label) mod k, so every fold holds each
    label's rows in proportion (sizes differ by at most one)."""
    h = df.withColumn("_ck_h", F.unhex(hash_key(key, seed)))  # ordered as the hex text, in half the bytes
    r = row_index(h, ["_ck_h", *key], by=[label], name="_ck_i")
    return r.select(*[F.col(c) for c in df.columns], F.pmod(F.col("_ck_i"), F.lit(k)).cast("int").alias(name))


# --- U01–U03: set operations -------------------------------------------------

def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Nulls compare equal, as in pandas."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def dedup_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """U01 metrics: ``(rows_before, rows_after, removed)`` in one row."""
    before = df.agg(F.count(F.lit(1)).alias("rows_before"))
    after = drop_duplicates(df, subset).agg(F.count(F.lit(1)).alias("rows_after"))
    # Two one-row aggregates side by side (equi-join on a constant key).
    before, after = before.withColumn("_ck", F.lit(1)), after.withColumn("_ck", F.lit(1))
    return before.join(after, "_ck").select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("removed"))


def common_top(a: DataFrame, b: DataFrame, k: int = 5, item: str = "feature", score: str = "importance") -> DataFrame:
    """Items in the top-k of both rankings."""
    ta = top_k(a, score, k, [item]).select(item)
    tb = top_k(b, score, k, [item]).select(item)
    return ta.intersect(tb)


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """U03."""
    return df.unionByName(extra, allowMissingColumns=True)
