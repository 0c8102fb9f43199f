"""Cleaning and imputation."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.ordered import melt, quantile_values, quantiles
from cohortkit.operators.joins import broadcast_if_small
from cohortkit.operators.select import (cast_columns, columns_of_kind, drop_duplicates, drop_null_keys,
                                        inf_to_null)
from cohortkit.session import checkpoint_dir


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column; ties → smallest value.

    ``(column, mode, mode_count)``.  Counting is a partial aggregation per
    (column, value); choosing the winner is a second small aggregation.
    """
    cols = list(cols)
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("mode_count"))


def numeric_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent value of numeric columns; ties → numerically smallest
    (``SimpleImputer(strategy='most_frequent')``).  NaN is not a value."""
    cols = list(cols)
    if not cols:
        return {}
    long = melt(df, cols)
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("b"))
    return {r["column"]: r["b"]["value"] for r in best.collect()}


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict:
    return {r["column"]: r["mode"] for r in column_modes(df, cols).collect()} if cols else {}


def median_values(df: DataFrame, cols: Sequence[str]) -> dict:
    """Exact whole-column medians (distributed selection)."""
    if not cols:
        return {}
    return {c: v["median"] for c, v in quantile_values(df, cols, {"median": 0.5}).items()}


def _typed_fills(df: DataFrame, fills: dict) -> dict:
    """Integral columns take the fill value rounded half up (a median of
    an even count can end in .5); others take it as is."""
    from pyspark.sql import types as T
    integral = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
    out = {}
    for c, v in fills.items():
        if v is None:
            continue
        out[c] = int(math.floor(v + 0.5)) if c in integral and isinstance(v, float) else v
    return out


def _persisted(df: DataFrame) -> DataFrame:
    """Cut lineage before several passes: rows written to the cluster's shared checkpoint folder (they survive executor
    loss) by column and compressed, which takes a fraction of a checkpoint's disk, and each pass reads its columns alone.
    The folder is deleted when the session ends.  Rows that Parquet can't hold go to a reliable checkpoint."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if len({c.lower() for c in df.columns}) < len(df.columns) or any(t in kind for _, kind in df.dtypes for t in ("void", "interval", "variant")):
        return df.checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/kept-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns that have a NULL or NaN (``na.fill`` fills both), found in one pass."""
    if not cols:
        return []
    types = dict(df.dtypes)
    gap = lambda c: F.col(c).isNull() | F.isnan(c) if types[c] in ("float", "double") else F.col(c).isNull()
    row = df.agg(*[F.bool_or(gap(c)).alias(f"_ck_{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[i]]


def clean_data(df: DataFrame, keys: Sequence[str] = ("subject_id", "hadm_id"),
               persist: bool = True) -> DataFrame:
    """Dedup → ±inf/NaN to NULL → numeric NULLs by exact median → text
    NULLs by mode → drop rows with NULL keys → keys to bigint.

    Deliberate differences from the reference: keys are never imputed, and
    ±inf is nulled before the medians are taken.  Medians and modes are taken
    of columns that have NULLs; counting these is one pass without a shuffle
    of rows.  Fill values are bounded
    metadata (one per column) and come to the driver; rows never do.
    """
    keys = [k for k in keys if k in df.columns]
    base = inf_to_null(drop_duplicates(df))
    if persist:
        base = _persisted(base)
    num = [c for c in columns_of_kind(base, "numeric") if c not in keys]
    txt = [c for c in columns_of_kind(base, "string") if c not in keys]
    num, txt = with_nulls(base, num), with_nulls(base, txt)
    fills = _typed_fills(base, median_values(base, num))
    fills.update({c: v for c, v in mode_values(base, txt).items() if v is not None})
    out = base.na.fill(fills) if fills else base
    out = drop_null_keys(out, keys) if keys else out
    return cast_columns(out, keys, "bigint")


def handle_missing(df: DataFrame, numeric_strategy: str = "median", fill_value: float = 0.0,
                   cat_fill_value: str = "UNKNOWN", exclude: Sequence[str] = ()) -> DataFrame:
    """Numeric NULLs by median / mean / most_frequent / constant, text
    NULLs by a constant."""
    num = columns_of_kind(df, "numeric", exclude)
    txt = columns_of_kind(df, "string", exclude)
    if numeric_strategy == "median":
        gaps = with_nulls(df, num)
        # A selection passes over the rows several times: only these columns are kept for it, and ``df`` is not made again.
        fills = median_values(_persisted(df.select(*gaps)), gaps) if gaps else {}
    elif numeric_strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in num]).first() if num else None
        fills = {c: row[c] for c in num} if row else {}
    elif numeric_strategy == "most_frequent":
        fills = numeric_modes(df, num)
    elif numeric_strategy == "constant":
        fills = {c: fill_value for c in num}
    else:
        raise ValueError(numeric_strategy)
    fills = _typed_fills(df, fills)
    out = df.na.fill(fills) if fills else df
    return out.na.fill(cat_fill_value, subset=txt) if txt else out


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_count, missing_percentage)`` in one pass.
    NaN in float columns counts as missing (pandas ``isnull``)."""
    from pyspark.sql import types as T
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def miss(c):
        m = F.col(c).isNull()
        if isinstance(types[c], (T.FloatType, T.DoubleType)):
            m = m | F.isnan(c)
        return F.sum(m.cast("long")).alias(c)

    wide = df.agg(F.count(F.lit(1)).alias("_ck_n"), *[miss(c) for c in cols])
    long = wide.unpivot(["_ck_n"], cols, "column", "missing_count")
    return long.select("column", F.col("missing_count").cast("long").alias("missing_count"),
                       (F.col("missing_count") / F.col("_ck_n") * 100.0).alias("missing_percentage"))


def iqr_filter(df: DataFrame, cols: Sequence[str], k: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose values lie within [q1 − k·IQR, q3 + k·IQR] for
    every column (exact quartiles, optionally per group).  A NULL value fails
    the test, as a pandas boolean mask does."""
    cols = list(cols)
    by = list(by)
    if not by:
        qv = quantile_values(df, cols, {"q1": 0.25, "q3": 0.75})
        cond = F.lit(True)
        for c in cols:
            q1, q3 = qv[c]["q1"], qv[c]["q3"]
            if q1 is None:
                cond = cond & F.lit(False)
                continue
            iqr = q3 - q1
            cond = cond & F.col(c).between(q1 - k * iqr, q3 + k * iqr)
        return df.where(cond)
    q = quantiles(df, cols, {"q1": 0.25, "q3": 0.75}, by=by)
    b = q.groupBy(*by).agg(*[e for c in cols for e in (
        F.max(F.when(F.col("column") == c, F.col("q1") - k * (F.col("q3") - F.col("q1")))).alias(f"_ck_lo_{c}"),
        F.max(F.when(F.col("column") == c, F.col("q3") + k * (F.col("q3") - F.col("q1")))).alias(f"_ck_hi_{c}"))])
    # The bounds first, then their size: joined by key, a group of most rows would be one task's.
    checkpoint_dir(df.sparkSession)
    j = df.join(broadcast_if_small(b.checkpoint(eager=True), 100_000), by, "left")
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.coalesce(F.col(c).between(F.col(f"_ck_lo_{c}"), F.col(f"_ck_hi_{c}")), F.lit(False))
    return j.where(cond).select(*df.columns)
