"""Per-admission measurement features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.ordered import cut_by_range, quantiles
from cohortkit.session import checkpoint_dir

# Suffixes of the seven per-group statistics, in output order.
STAT_SUFFIXES = ["mean", "std", "min", "max", "median", "range", "iqr"]


HOT_ROWS = 1_000_000


def key_sketch(df: DataFrame, key: Sequence[str], tracked: int) -> DataFrame:
    """One row: the number of rows with a key, and the most frequent key hashes by a mergeable heavy-hitter
    sketch of ``tracked`` items.  Tasks hand on their sketch alone."""
    return _with_key(df, key).select(F.xxhash64(*key).alias("_ck_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_ck_h, {tracked}, {tracked})").alias("top"))


def find_hot_keys(df: DataFrame, key: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys (no NULL among them) of more than ``hot_rows`` rows with
    their row count ``_ck_n``, in a reliable checkpoint; None if there are none.

    A sketch (``key_sketch``) names the candidates.  Its counts are at most 3.5 n / slots too high and it leaves out no
    key above twice that error, so it is made large enough for ``hot_rows``; only the candidates' rows are then counted, so keys are not
    shuffled unless some are hot.  There are at most n / hot_rows candidates and as many more within the error.  Where even the largest
    sketch is too coarse (n over about 190,000 x hot_rows), all keys are counted."""
    checkpoint_dir(df.sparkSession)
    key, tracked = list(key), 10_000
    while True:
        n, top = key_sketch(df, key, tracked).select("n", F.filter("top", lambda t: t["count"] > hot_rows)).first()
        if n <= hot_rows or not top and 7 * n <= hot_rows * _slots(tracked):
            return None
        if 7 * n <= hot_rows * _slots(tracked) or tracked == MOST_TRACKED:
            break
        tracked = min(MOST_TRACKED, max(tracked + 1, -(-21 * n // (4 * hot_rows))))
    rows = _with_key(df, key)
    if 7 * n <= hot_rows * _slots(tracked):
        candidates = df.sparkSession.createDataFrame([(t["item"],) for t in top], "_ck_h bigint")
        rows = rows.join(F.broadcast(candidates), F.xxhash64(*key) == F.col("_ck_h"), "left_semi")
    hot = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_ck_n")).where(F.col("_ck_n") > hot_rows).checkpoint(eager=True)
    return None if hot.isEmpty() else hot


#: Spark's limit on the items of a sketch.
MOST_TRACKED = 1_000_000


def _slots(tracked: int) -> int:
    """The hash slots of a sketch of ``tracked`` items: the power of two that is three quarters full with them."""
    return 1 << (-(-4 * tracked // 3) - 1).bit_length()


def _has_key(key: Sequence[str]):
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).isNotNull()
    return out


def _with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows without a key form no group (as pandas drops NULL groups); they
    never reach a shuffle by key."""
    return df.where(_has_key(key))


def _null_features(df: DataFrame, key: Sequence[str], like: DataFrame) -> DataFrame:
    """The rows without a key, with NULL in the columns that ``like`` adds."""
    own = set(df.columns)
    return df.where(~_has_key(key)).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema if f.name not in own])


def group_stats(df: DataFrame, key: Sequence[str] | str, cols: Sequence[str], hot: DataFrame | bool | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per key and column mean, sample std, min, max, exact median,
    range and IQR (q75 − q25, linear interpolation).

    Ordinary keys: one aggregation computes everything (exact
    ``percentile`` on a group of at most ``hot_rows`` values).  Hot keys
    (``find_hot_keys``): moments by partial aggregation, quantiles by the
    bounded-memory selection helper, never a whole hot key in one buffer.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols = list(cols)
    df = _with_key(df, key)
    hot = find_hot_keys(df, key, hot_rows) if hot is None else hot

    def stats_of(frame, with_quantiles=True):
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
                     F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
            if with_quantiles:
                aggs.append(F.percentile(F.col(c).cast("double"), [0.25, 0.5, 0.75]).alias(f"{c}_q"))
        return frame.groupBy(*key).agg(*aggs)

    def shape(frame, qexpr):
        return frame.select(*key, *[e for c in cols for e in (
            F.col(f"{c}_mean"), F.col(f"{c}_std"), F.col(f"{c}_min"), F.col(f"{c}_max"),
            qexpr(c, 1).alias(f"{c}_median"), (F.col(f"{c}_max") - F.col(f"{c}_min")).alias(f"{c}_range"),
            (qexpr(c, 2) - qexpr(c, 0)).alias(f"{c}_iqr"))])

    def from_array(c, i):
        return F.col(f"{c}_q")[i]

    if hot is None or hot is False:
        return shape(stats_of(df), from_array)
    hot_df = hot.select(*key)
    normal = shape(stats_of(df.join(hot_df, key, "left_anti")), from_array)
    heavy = df.join(hot_df, key, "left_semi")
    q = quantiles(heavy, cols, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by=key, max_candidates=hot_rows)
    qw = q.groupBy(*key).agg(*[F.array(*[F.max(F.when(F.col("column") == c, F.col(n))) for n in ("q25", "median", "q75")])
                               .alias(f"{c}_q") for c in cols])
    heavy_stats = shape(stats_of(heavy, False).join(qw, key, "left"), from_array)
    return normal.unionByName(heavy_stats)


def trend(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], cols: Sequence[str],
          hot_rows: int = HOT_ROWS, num_partitions: int | None = None, hot: DataFrame | bool | None = None) -> DataFrame:
    """``{col}_trend`` = value minus the previous value of the same
    key along ``order`` (unique within a key), and ``{col}_trend_sign``.
    Rows without a key get NULL.

    Keys with at most ``hot_rows`` rows take the ordinary window (one
    shuffle by key).  Hot keys -- one may hold a third of all rows -- are
    cut into ranges of (key, order), so no task holds a whole key: the lag
    runs per (key, range), and the first row of a range takes the last row
    of the key's range before, from a table of one row per key and range.
    ``hot``: known hot keys (``find_hot_keys``), or False for none.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = list(order)
    cols = list(cols)
    keyed = _with_key(df, key)
    if hot is None:
        hot = find_hot_keys(keyed, key, hot_rows)
    if hot is None or hot is False:
        out = _lag_by_window(keyed, key, order, cols)
        return out.unionByName(_null_features(df, key, out))
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
                              int(hot.agg(F.sum("_ck_n")).first()[0]) // hot_rows + 1)
    out = _lag_by_window(keyed.join(hot.select(*key), key, "left_anti"), key, order, cols)
    heavy = cut_by_range(keyed.join(hot.select(*key), key, "left_semi"), [*key, *order], n, "_ck_b")
    part = [*key, "_ck_b"]
    payload = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    # Ranges sort and compress well, so tasks merged by their bytes would hold millions of rows: each range keeps its own.
    local = heavy.repartition(n, *part).withColumn("_ck_prev", F.lag(payload).over(Window.partitionBy(*part).orderBy(*order)))
    last = heavy.groupBy(*part).agg(F.max_by(payload, F.struct(*order)).alias("_ck_last"))
    edge = last.select(*part, F.lag("_ck_last").over(Window.partitionBy(*key).orderBy("_ck_b")).alias("_ck_edge"))
    j = local.join(F.broadcast(edge), part, "left")  # a row per range and hot key beginning in it
    prev = F.coalesce(F.col("_ck_prev"), F.col("_ck_edge"))
    exprs = []
    for i, c in enumerate(cols):
        d = F.col(c) - prev[f"v{i}"]
        exprs += [d.alias(f"{c}_trend"), F.signum(d).alias(f"{c}_trend_sign")]
    out = out.unionByName(j.select(*[F.col(c) for c in df.columns], *exprs))
    return out.unionByName(_null_features(df, key, out))


def _lag_by_window(df, key, order, cols):
    w = Window.partitionBy(*key).orderBy(*order)
    exprs = []
    for c in cols:
        d = F.col(c) - F.lag(c).over(w)
        exprs += [d.alias(f"{c}_trend"), F.signum(d).alias(f"{c}_trend_sign")]
    return df.select("*", *exprs)


def bound_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``{col}_is_abnormal`` when ``{col}_lower`` and ``{col}_upper`` exist.
    A null comparison counts as normal (0)."""
    exprs = []
    for c in cols:
        lo, hi = f"{c}_lower", f"{c}_upper"
        if lo in df.columns and hi in df.columns:
            bad = (F.col(c) < F.col(lo)) | (F.col(c) > F.col(hi))
            exprs.append(F.coalesce(bad, F.lit(False)).cast("int").alias(f"{c}_is_abnormal"))
    return df.select("*", *exprs)


def _window_features(df: DataFrame, key: list, order: list, cols: list) -> DataFrame:
    """Statistics and trend of ordinary keys in one shuffle: one window
    partitioned by key (aggregates over the whole key, lag along the
    order); Spark sorts once by (key, order) for both."""
    wk = Window.partitionBy(*key)
    wo = Window.partitionBy(*key).orderBy(*order)
    trends, stats = [], []
    for c in cols:
        d = F.col(c) - F.lag(c).over(wo)
        trends += [d.alias(f"{c}_trend"), F.signum(d).alias(f"{c}_trend_sign")]
        q = F.percentile(F.col(c).cast("double"), [0.25, 0.5, 0.75]).over(wk)
        mn, mx = F.min(c).over(wk), F.max(c).over(wk)
        stats += [F.avg(c).over(wk).alias(f"{c}_mean"), F.stddev_samp(c).over(wk).alias(f"{c}_std"),
                  mn.alias(f"{c}_min"), mx.alias(f"{c}_max"), q[1].alias(f"{c}_median"),
                  (mx - mn).alias(f"{c}_range"), (q[2] - q[0]).alias(f"{c}_iqr")]
    return df.select("*", *trends, *stats)


def key_features(df: DataFrame, key: str | Sequence[str], order: Sequence[str], cols: Sequence[str],
                 hot: DataFrame | bool | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A03 + J03 + W01 + W02: every row with its key's statistics and its
    trend (NULL without a key).  Ordinary keys take a single window pass (one
    shuffle, no join back).  Hot keys (``find_hot_keys``) take the
    bounded-memory paths: trend over ranges and selection quantiles, with
    their one-row-per-key statistics joined back."""
    key = [key] if isinstance(key, str) else list(key)
    order, cols = list(order), list(cols)
    keyed = _with_key(df, key)
    if hot is None:
        hot = find_hot_keys(keyed, key, hot_rows)
    if hot is None or hot is False:
        out = _window_features(keyed, key, order, cols)
        return out.unionByName(_null_features(df, key, out))
    normal = _window_features(keyed.join(hot.select(*key), key, "left_anti"), key, order, cols)
    heavy = keyed.join(hot.select(*key), key, "left_semi")
    stats = group_stats(heavy, key, cols, hot=hot, hot_rows=hot_rows)
    out = normal.unionByName(trend(heavy, key, order, cols, hot=hot, hot_rows=hot_rows).join(stats, key, "left"))
    return out.unionByName(_null_features(df, key, out))


def lab_features(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                 cols: Sequence[str] | None = None, hot: DataFrame | bool | None = None) -> DataFrame:
    """A03 + J03 + W01 + W02 + F09.  ``cols`` defaults to every column whose
    lower-cased name contains ``lab_`` (P02)."""
    from cohortkit.operators.select import select_by_substring

    key_l = [key] if isinstance(key, str) else list(key)
    cols = list(cols) if cols is not None else [
        c for c in select_by_substring(df, "lab_") if not c.endswith(("_lower", "_upper"))]
    return bound_flags(key_features(df, key_l, order, cols, hot=hot), cols)


# Reference ranges of five lab items
# (itemid, name, unit, lower, upper).
LAB_REFERENCE_RANGES = [
    (50809, "Glucose", "mg/dL", 70.0, 100.0),
    (50810, "Creatinine", "mg/dL", 0.6, 1.2),
    (50811, "Hemoglobin", "g/dL", 12.0, 16.0),
    (50822, "Potassium", "mEq/L", 3.5, 5.0),
    (50931, "WBC", "K/uL", 4.5, 11.0),
]

LAB_REF_SCHEMA = T.StructType([
    T.StructField("itemid", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("unit", T.StringType()), T.StructField("lower", T.DoubleType()),
    T.StructField("upper", T.DoubleType())])


def lab_reference(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or LAB_REFERENCE_RANGES, LAB_REF_SCHEMA)


def flag_abnormal(df: DataFrame, item_col: str, value_col: str, ref: DataFrame,
                  name: str = "is_abnormal") -> DataFrame:
    """join the (tiny, fixed-size) reference table by broadcast and flag
    values outside [lower, upper]; items without a range get NULL, a null
    value counts as normal."""
    r = ref.select(F.col("itemid").alias("_ck_item"), F.col("lower").alias("_ck_lo"),
                   F.col("upper").alias("_ck_hi"))
    j = df.join(F.broadcast(r), F.col(item_col) == F.col("_ck_item"), "left")
    bad = (F.col(value_col) < F.col("_ck_lo")) | (F.col(value_col) > F.col("_ck_hi"))
    flag = F.when(F.col("_ck_item").isNull(), None).otherwise(F.coalesce(bad, F.lit(False)))
    return j.select(*[F.col(c) for c in df.columns], flag.alias(name))
