"""Registered queries over the benchmark tables, one per operator ID, and
their independent SQL oracles.

Table roles (see FIXTURES.md): ``orders`` = admissions (o_orderkey = hadm,
o_custkey = subject), ``customer`` = patients, ``lineitem`` = lab events
(l_quantity = value, l_shipdate = event time), ``events`` = time series,
``documents`` = text, ``labels`` ⟕ ``documents`` = scored table.

Every query reads whole tables.  Doubles are rounded to 6 decimals on both
sides of the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions import temporal as tm
from cohortkit.functions.ordered import average_rank, quantiles
from cohortkit.operators import clean, evaluate as ev, features as fe, interpret as xp, joins, lab, ml, scale, select as sel, stats
from cohortkit.sources.tables import Tables

# Unique order of lab events within an admission (line numbers repeat).
TREND_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LAB_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _digits(name: str) -> int:
    # Per-group standard deviations are irrational and differ between
    # engines in the last bits (~1e-11 at magnitude 1e4); 3 decimals keep a
    # last-bit difference from flipping a rounding boundary.
    return 3 if name.endswith("_std") else 6


def r6(df: DataFrame) -> DataFrame:
    """Round every float/double column to 6 decimals (3 for ``*_std``);
    + 0.0 turns a negative zero into a positive one, as on the SQL side."""
    return df.select(*[(F.round(F.col(f.name), _digits(f.name)) + F.lit(0.0)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# --- shared derived tables ---------------------------------------------------

def adm(t: Tables) -> DataFrame:
    """Admissions ⟕ patients."""
    return joins.merge(t.orders, t.customer, ["o_custkey"], ["c_custkey"], "left")


def wide(t: Tables) -> DataFrame:
    """(admissions ⟕ patients) ⟕ lab events."""
    return joins.merge(adm(t), t.lineitem, ["o_orderkey"], ["l_orderkey"], "left", skewed_right=True)


def scored(t: Tables) -> DataFrame:
    """Scored table: label = document quality, score = a length ratio cut to
    two decimals (ties on purpose), prediction = score ≥ 0.5."""
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    s = F.floor(F.col("n_chars") / (F.col("n_chars") + 1000.0) * 100) / 100.0
    return d.select("doc_id", F.col("quality").alias("label"), s.alias("score"),
                    (s >= 0.5).cast("int").alias("prediction"))


def scored_b(t: Tables) -> DataFrame:
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    s = F.pmod(F.col("n_chars"), F.lit(997)) / 997.0
    return d.select("doc_id", F.col("quality").alias("label"), s.alias("score"),
                    (s >= 0.5).cast("int").alias("prediction"))


def is_final(col="o_orderstatus"):
    return (F.col(col) == "F").cast("int")


ADM_SQL = "(SELECT * FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"
WIDE_SQL = f"(SELECT * FROM {ADM_SQL} a LEFT JOIN lineitem l ON a.o_orderkey = l.l_orderkey)"
SCORED_SQL = ("(SELECT doc_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM "
              "(SELECT lb.doc_id, lb.quality AS label, floor(d.n_chars / (d.n_chars + 1000.0) * 100) / 100.0 AS score "
              "FROM labels lb JOIN documents d ON lb.doc_id = d.doc_id))")
SCORED_B_SQL = ("(SELECT doc_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM "
                "(SELECT lb.doc_id, lb.quality AS label, (d.n_chars % 997) / 997.0 AS score "
                "FROM labels lb JOIN documents d ON lb.doc_id = d.doc_id))")


def _sql_fixed_holiday(d: str) -> str:
    return (f"((month({d})=1 AND day({d})=1) OR (month({d})=6 AND day({d})=19 AND year({d})>=2021) "
            f"OR (month({d})=7 AND day({d})=4) OR (month({d})=11 AND day({d})=11) OR (month({d})=12 AND day({d})=25))")


def sql_is_holiday(col: str) -> str:
    d = f"CAST({col} AS DATE)"
    fl = (f"((isodow({d})=1 AND ((month({d})=1 AND day({d}) BETWEEN 15 AND 21 AND year({d})>=1986) "
          f"OR (month({d})=2 AND day({d}) BETWEEN 15 AND 21) OR (month({d})=5 AND day({d})>=25) "
          f"OR (month({d})=9 AND day({d})<=7) OR (month({d})=10 AND day({d}) BETWEEN 8 AND 14))) "
          f"OR (isodow({d})=4 AND month({d})=11 AND day({d}) BETWEEN 22 AND 28))")
    obs = (f"((isodow({d})=5 AND {_sql_fixed_holiday(f'({d} + INTERVAL 1 DAY)')}) "
           f"OR (isodow({d})=1 AND {_sql_fixed_holiday(f'({d} - INTERVAL 1 DAY)')}))")
    return f"({_sql_fixed_holiday(d)} OR {fl} OR {obs})"


def sql_temporal(col: str) -> str:
    pi = "pi()"
    return ", ".join([
        f"CAST(hour({col}) AS INTEGER) AS {col}_hour", f"CAST(day({col}) AS INTEGER) AS {col}_day",
        f"CAST(month({col}) AS INTEGER) AS {col}_month", f"CAST(year({col}) AS INTEGER) AS {col}_year",
        f"CAST(isodow({col}) - 1 AS INTEGER) AS {col}_dayofweek",
        f"round(sin(2*{pi}*hour({col})/24), 6) AS {col}_hour_sin",
        f"round(cos(2*{pi}*hour({col})/24), 6) AS {col}_hour_cos",
        f"round(sin(2*{pi}*month({col})/12), 6) AS {col}_month_sin",
        f"round(cos(2*{pi}*month({col})/12), 6) AS {col}_month_cos",
        f"CAST(coalesce({sql_is_holiday(col)}, false) AS INTEGER) AS {col}_is_holiday",
        f"CAST(coalesce(isodow({col}) IN (6, 7), false) AS INTEGER) AS {col}_is_weekend"])


def _r(cols, prefix=""):
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in cols)


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_SEL = ", ".join(c if c not in LAB_COLS else f"round({c}, 6) AS {c}" for c in LI_COLS)
ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
DBL = {"o_totalprice", "c_acctbal", *LAB_COLS}


def _sel(cols, src=""):
    return ", ".join(f"round({src}{c}, 6) AS {c}" if c in DBL else f"{src}{c}" for c in cols)


WIDE_COLS = ORD_COLS + CUST_COLS + LI_COLS


# --- queries -----------------------------------------------------------------
# Each: (spark, sf_dir) -> DataFrame.  Registered in REGISTRY below.

def q_flagship(spark, d):
    """J01 → J02 → U01 → A03 + J03 → W01/W02 → F06 in one plan.

    Duplicates are removed below the join (distinct(L ⋈ R) equals
    distinct(L) ⋈ distinct(R)).  Hot admissions are found from the lab
    table's key column alone and take the bounded-memory paths; the other
    lab rows are hash-partitioned by admission once, and that one shuffle
    serves the dedup, the join and the statistics/trend window."""
    t = Tables(spark, d)
    a = sel.drop_duplicates(adm(t)).select("o_orderkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", *TREND_ORDER, "l_quantity")
    keyed = li.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    hot = lab.find_hot_keys(keyed, ["o_orderkey"], lab.HOT_ROWS)
    # U01 on the full lab rows (all columns), before projecting.
    full = t.lineitem
    if hot is not None:
        hot_df = hot.select(F.col("o_orderkey").alias("l_orderkey"))
        normal_li, hot_li = full.join(hot_df, "l_orderkey", "left_anti"), full.join(hot_df, "l_orderkey", "left_semi")
    else:
        normal_li, hot_li = full, None

    def joined(rows):
        return a.join(rows, a.o_orderkey == rows.l_orderkey).select(
            "o_orderkey", "o_orderdate", *TREND_ORDER, "l_quantity")

    normal = joined(sel.drop_duplicates(normal_li.repartition("l_orderkey")))
    feats = lab.key_features(normal, "o_orderkey", TREND_ORDER, ["l_quantity"], hot=False)
    if hot_li is not None:
        heavy = joined(sel.drop_duplicates(hot_li))
        feats = feats.unionByName(lab.key_features(heavy, "o_orderkey", TREND_ORDER, ["l_quantity"], hot=hot))
    # J02 is a left join: admissions without lab rows keep one row of NULLs.
    own = {"o_orderkey", "o_orderdate"}
    alone = a.join(t.lineitem.select("l_orderkey"), a.o_orderkey == F.col("l_orderkey"), "left_anti").select(
        "o_orderkey", "o_orderdate", *[F.lit(None).cast(x.dataType).alias(x.name) for x in feats.schema if x.name not in own])
    feats = feats.unionByName(alone)
    out = feats.select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        *[f"l_quantity_{s}" for s in lab.STAT_SUFFIXES], "l_quantity_trend", "l_quantity_trend_sign",
        tm.days_between("o_orderdate", "l_shipdate").alias("los_days"))
    return r6(out)


SQL_flagship = f"""
WITH w AS (SELECT DISTINCT * FROM {WIDE_SQL} x),
g AS (SELECT o_orderkey, avg(l_quantity) m, stddev_samp(l_quantity) s, min(l_quantity) mn, max(l_quantity) mx,
             quantile_cont(l_quantity, 0.5) med, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) iqr
      FROM w GROUP BY o_orderkey)
SELECT w.o_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, round(l_quantity, 6) AS l_quantity,
  round(m, 6) AS l_quantity_mean, round(s, 3) AS l_quantity_std, round(mn, 6) AS l_quantity_min,
  round(mx, 6) AS l_quantity_max, round(med, 6) AS l_quantity_median, round(mx - mn, 6) AS l_quantity_range,
  round(iqr, 6) AS l_quantity_iqr,
  round(l_quantity - lag(l_quantity) OVER (PARTITION BY w.o_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice), 6) AS l_quantity_trend,
  CAST(sign(l_quantity - lag(l_quantity) OVER (PARTITION BY w.o_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS DOUBLE) AS l_quantity_trend_sign,
  round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0, 6) AS los_days
FROM w JOIN g ON w.o_orderkey = g.o_orderkey
"""


def q_S01(spark, d):
    from cohortkit.sources import tables
    named = tables.load_named(spark, {n: f"{d}/{n}.parquet" for n in ("orders", "customer", "lineitem")}, "parquet")
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows") for n, df in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL_S01 = ("SELECT 'orders' AS \"table\", count(*) AS n_rows FROM orders UNION ALL "
           "SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem")


def q_S04(spark, d):
    return r6(sel.drop_any_null(wide(Tables(spark, d))))


SQL_S04 = (f"SELECT {_sel(WIDE_COLS)} FROM {WIDE_SQL} x WHERE "
           + " AND ".join(f"{c} IS NOT NULL" for c in WIDE_COLS))


def q_S04_load(spark, d):
    from cohortkit.sources import tables
    return r6(tables.load_complete(spark, f"{d}/events.parquet"))


SQL_S04_load = "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ["event_id", "ts", "user_id", "event_type", "value", "props"])


def q_S05(spark, d):
    """Listed features that exist, and the target."""
    from cohortkit.sources import tables
    return r6(tables.project_features(Tables(spark, d).orders, ["o_totalprice", "absent", "o_orderpriority"], "o_orderstatus"))


SQL_S05 = "SELECT round(o_totalprice, 6) AS o_totalprice, o_orderpriority, o_orderstatus FROM orders"


def q_S06(spark, d):
    """The same projection by a feature-list file."""
    from cohortkit.sources import sinks, tables
    path = _scratch(spark, "s06")
    sinks.write_feature_list(spark, ["o_totalprice", "o_orderpriority"], path)
    return r6(tables.project_features(Tables(spark, d).orders, sinks.read_feature_list(spark, path), "o_orderstatus"))


SQL_S06 = SQL_S05


def q_J01(spark, d):
    return r6(adm(Tables(spark, d)))


SQL_J01 = f"SELECT {_sel(ORD_COLS + CUST_COLS)} FROM {ADM_SQL} x"


def q_J02(spark, d):
    return r6(wide(Tables(spark, d)))


SQL_J02 = f"SELECT {_sel(WIDE_COLS)} FROM {WIDE_SQL} x"


def q_J03(spark, d):
    t = Tables(spark, d)
    g = lab.group_stats(t.lineitem, "l_orderkey", ["l_quantity"])
    return r6(joins.join_back(t.lineitem, g, ["l_orderkey"]))


SQL_J03 = f"""
SELECT {LI_SEL}, round(m, 6) AS l_quantity_mean, round(s, 3) AS l_quantity_std, round(mn, 6) AS l_quantity_min,
  round(mx, 6) AS l_quantity_max, round(med, 6) AS l_quantity_median, round(mx - mn, 6) AS l_quantity_range,
  round(iqr, 6) AS l_quantity_iqr
FROM lineitem l LEFT JOIN (SELECT l_orderkey AS k, avg(l_quantity) m, stddev_samp(l_quantity) s, min(l_quantity) mn,
  max(l_quantity) mx, quantile_cont(l_quantity, 0.5) med,
  quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) iqr FROM lineitem GROUP BY l_orderkey) g
ON l.l_orderkey = g.k
"""


def q_J05(spark, d):
    t = Tables(spark, d)
    o = t.orders
    yr = o.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    hol = tm.holiday_dim(spark, yr["a"], yr["b"])
    return r6(tm.flag_holidays_by_join(o, "o_orderdate", hol, "o_orderdate_is_holiday"))


SQL_J05 = (f"SELECT {_sel(ORD_COLS)}, CAST(coalesce({sql_is_holiday('o_orderdate')}, false) AS INTEGER) "
           f"AS o_orderdate_is_holiday FROM orders")


def q_A03(spark, d):
    t = Tables(spark, d)
    return r6(lab.group_stats(t.lineitem, "l_orderkey", ["l_quantity", "l_extendedprice", "l_discount"]))


def _sql_group_stats(key, cols, src):
    parts = []
    for c in cols:
        parts += [f"round(avg({c}), 6) AS {c}_mean", f"round(stddev_samp({c}), 3) AS {c}_std",
                  f"round(min({c}), 6) AS {c}_min", f"round(max({c}), 6) AS {c}_max",
                  f"round(quantile_cont({c}, 0.5), 6) AS {c}_median", f"round(max({c}) - min({c}), 6) AS {c}_range",
                  f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS {c}_iqr"]
    return f"SELECT {key}, {', '.join(parts)} FROM {src} GROUP BY {key}"


SQL_A03 = _sql_group_stats("l_orderkey", ["l_quantity", "l_extendedprice", "l_discount"], "lineitem")


def q_W01(spark, d):
    t = Tables(spark, d)
    out = lab.trend(t.lineitem, "l_orderkey", TREND_ORDER, ["l_quantity", "l_extendedprice"])
    return r6(out.drop("l_quantity_trend_sign", "l_extendedprice_trend_sign"))


_W = "OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
SQL_W01 = (f"SELECT {LI_SEL}, round(l_quantity - lag(l_quantity) {_W}, 6) AS l_quantity_trend, "
           f"round(l_extendedprice - lag(l_extendedprice) {_W}, 6) AS l_extendedprice_trend FROM lineitem")


def q_W02(spark, d):
    t = Tables(spark, d)
    out = lab.trend(t.lineitem, "l_orderkey", TREND_ORDER, ["l_quantity"])
    return r6(out.drop("l_quantity_trend"))


SQL_W02 = f"SELECT {LI_SEL}, CAST(sign(l_quantity - lag(l_quantity) {_W}) AS DOUBLE) AS l_quantity_trend_sign FROM lineitem"


def q_F06(spark, d):
    w = wide(Tables(spark, d))
    return r6(w.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "l_shipdate",
                       tm.days_between("o_orderdate", "l_shipdate").alias("los_days")))


SQL_F06 = ("SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, l_shipdate, "
           f"round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0, 6) AS los_days FROM {WIDE_SQL} x")


def q_F07(spark, d):
    w = wide(Tables(spark, d))
    death = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    return r6(w.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       tm.days_between("o_orderdate", death).alias("time_to_death")))


SQL_F07 = ("SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, round((epoch_us(CASE WHEN l_returnflag = 'R' "
           "THEN l_shipdate END) - epoch_us(o_orderdate)) / 86400000000.0, 6) AS time_to_death "
           f"FROM {WIDE_SQL} x")


def q_F01(spark, d):
    return tm.admission_parts(Tables(spark, d).orders, "o_orderdate").transform(r6)


SQL_F01 = (f"SELECT {_sel(ORD_COLS)}, CAST(hour(o_orderdate) AS INTEGER) AS admission_hour, "
           "CAST(isodow(o_orderdate) - 1 AS INTEGER) AS admission_day_of_week, "
           "CAST(month(o_orderdate) AS INTEGER) AS admission_month, "
           "CAST(quarter(o_orderdate) AS INTEGER) AS admission_quarter FROM orders")

EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EV_SEL = "event_id, ts, user_id, event_type, round(value, 6) AS value, props"


def q_F02(spark, d):
    e = Tables(spark, d).events
    cols = tm.temporal_columns("ts")[:5]
    return r6(e.select("*", *cols))


_TS_PARTS = [
    "CAST(hour(ts) AS INTEGER) AS ts_hour", "CAST(day(ts) AS INTEGER) AS ts_day",
    "CAST(month(ts) AS INTEGER) AS ts_month", "CAST(year(ts) AS INTEGER) AS ts_year",
    "CAST(isodow(ts) - 1 AS INTEGER) AS ts_dayofweek",
    "round(sin(2*pi()*hour(ts)/24), 6) AS ts_hour_sin", "round(cos(2*pi()*hour(ts)/24), 6) AS ts_hour_cos",
    "round(sin(2*pi()*month(ts)/12), 6) AS ts_month_sin", "round(cos(2*pi()*month(ts)/12), 6) AS ts_month_cos",
    f"CAST(coalesce({sql_is_holiday('ts')}, false) AS INTEGER) AS ts_is_holiday",
    "CAST(coalesce(isodow(ts) IN (6, 7), false) AS INTEGER) AS ts_is_weekend"]
SQL_F02 = f"SELECT {EV_SEL}, {', '.join(_TS_PARTS[:5])} FROM events"


def q_F03(spark, d):
    e = Tables(spark, d).events
    return r6(e.select("*", *tm.temporal_columns("ts")[5:9]))


SQL_F03 = f"SELECT {EV_SEL}, {', '.join(_TS_PARTS[5:9])} FROM events"


def q_F04(spark, d):
    """Holiday flag as a pure expression, on admissions (1995–2001) and events (2024)."""
    o = Tables(spark, d).orders
    return r6(o.select("*", F.coalesce(tm.is_us_holiday("o_orderdate"), F.lit(False)).cast("int")
                       .alias("o_orderdate_is_holiday")))


SQL_F04 = SQL_J05


def q_F04_events(spark, d):
    e = Tables(spark, d).events
    return r6(e.select("*", tm.temporal_columns("ts")[9]))


SQL_F04_events = f"SELECT {EV_SEL}, {_TS_PARTS[9]} FROM events"


def q_F05(spark, d):
    e = Tables(spark, d).events
    return r6(e.select("*", tm.temporal_columns("ts")[10]))


SQL_F05 = f"SELECT {EV_SEL}, {_TS_PARTS[10]} FROM events"


def q_temporal_all(spark, d):
    """F02–F07 in one projection on the joined table (admit, discharge, death)."""
    w = wide(Tables(spark, d)).select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      F.col("o_orderdate").alias("admit"), F.col("l_shipdate").alias("disch"))
    return r6(tm.temporal_features(w, ["admit", "disch"], admit="admit", disch="disch"))


SQL_temporal_all = ("SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, admit, disch, "
                    + sql_temporal("admit") + ", " + sql_temporal("disch")
                    + ", round((epoch_us(disch) - epoch_us(admit)) / 86400000000.0, 6) AS los_days FROM "
                    f"(SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate AS admit, "
                    f"l_shipdate AS disch FROM {WIDE_SQL} x) y")


# --- P: projections, filters, casts -------------------------------------------

def q_P01(spark, d):
    return r6(sel.select_kind(wide(Tables(spark, d)), "numeric"))


WIDE_NUM = ["o_orderkey", "o_custkey", "o_totalprice", "c_custkey", "c_nationkey", "c_acctbal", "l_orderkey",
            "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SQL_P01 = f"SELECT {_sel(WIDE_NUM)} FROM {WIDE_SQL} x"


def q_P02(spark, d):
    w = wide(Tables(spark, d))
    return r6(w.select(*sel.select_by_substring(w, "PRICE")))


SQL_P02 = f"SELECT round(o_totalprice, 6) AS o_totalprice, round(l_extendedprice, 6) AS l_extendedprice FROM {WIDE_SQL} x"


def q_P03(spark, d):
    w = wide(Tables(spark, d)).withColumn("target", is_final())
    return r6(sel.extract_features(w, target="target"))


P03_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_custkey", "c_name",
            "c_nationkey", "c_acctbal", "c_mktsegment", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SQL_P03 = f"SELECT {_sel(P03_COLS)} FROM {WIDE_SQL} x"


AS_OF = "2001-06-01 00:00:00"


def q_P04(spark, d):
    w = wide(Tables(spark, d)).select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      "o_orderdate", "l_shipdate")
    return tm.validate_temporal(w, "o_orderdate", "l_shipdate", as_of=AS_OF)


SQL_P04 = f"""
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, a AS o_orderdate,
  CASE WHEN dd < a THEN NULL ELSE dd END AS l_shipdate
FROM (SELECT *, CASE WHEN o_orderdate > TIMESTAMP '{AS_OF}' THEN NULL ELSE o_orderdate END AS a,
             CASE WHEN l_shipdate > TIMESTAMP '{AS_OF}' THEN NULL ELSE l_shipdate END AS dd FROM {WIDE_SQL} x) y
"""


def q_P05(spark, d):
    return r6(sel.drop_null_keys(wide(Tables(spark, d)), ["o_custkey", "l_orderkey"]))


SQL_P05 = f"SELECT {_sel(WIDE_COLS)} FROM {WIDE_SQL} x WHERE o_custkey IS NOT NULL AND l_orderkey IS NOT NULL"


def q_P06(spark, d):
    t = Tables(spark, d)
    # nullif makes real NULLs inside lineitem itself, beside the join's.
    w = wide(t).withColumn("l_discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))
    return r6(sel.drop_any_null(w))


SQL_P06 = (f"SELECT {_sel(WIDE_COLS)} FROM (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM {WIDE_SQL} x) y WHERE "
           + " AND ".join(f"{c} IS NOT NULL" for c in WIDE_COLS))


def q_P07(spark, d):
    li = Tables(spark, d).lineitem
    x = (F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit(float("nan")))
         .when(F.col("l_discount") == 0, F.lit(float("inf")))
         .otherwise(F.col("l_tax") / F.col("l_discount")))
    return r6(sel.inf_to_null(li.withColumn("tax_ratio", x)))


SQL_P07 = f"SELECT {LI_SEL}, round(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END, 6) AS tax_ratio FROM lineitem"


def q_P08(spark, d):
    c = Tables(spark, d).customer
    return r6(sel.cast_columns(c, ["c_custkey", "c_nationkey"], "bigint"))


SQL_P08 = "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer"


def q_P09(spark, d):
    e = Tables(spark, d).events.select(
        "event_id", "props", F.regexp_extract("props", "[0-9]+", 0).alias("k_text"),
        F.col("user_id").cast("string").alias("user_text"), "event_type")
    return r6(sel.coerce_numeric(e, ["props", "k_text", "user_text", "event_type"]))


SQL_P09 = ("SELECT event_id, TRY_CAST(trim(props) AS DOUBLE) AS props, "
           "TRY_CAST(trim(regexp_extract(props, '[0-9]+', 0)) AS DOUBLE) AS k_text, "
           "TRY_CAST(trim(CAST(user_id AS VARCHAR)) AS DOUBLE) AS user_text, "
           "TRY_CAST(trim(event_type) AS DOUBLE) AS event_type FROM events")


def q_P09_codes(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority")
    return sel.category_codes(o, "o_orderpriority", "priority_code")


SQL_P09_codes = ("SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) "
                 "AS priority_code FROM orders")


def q_P11(spark, d):
    li = Tables(spark, d).lineitem
    return r6(sel.remap_binary_label(li, "l_linestatus", "label"))


SQL_P11 = f"SELECT {LI_SEL}, CAST(CASE WHEN l_linestatus = 'F' THEN 0 WHEN l_linestatus = 'O' THEN 1 END AS INTEGER) AS label FROM lineitem"


def q_P12(spark, d):
    w = wide(Tables(spark, d)).withColumn("target", is_final())
    return r6(sel.class_means(w, "target", LAB_COLS + ["o_totalprice"]))


SQL_P12 = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN o_orderstatus = 'F' THEN {c} END), 6) AS mean_pos, "
    f"round(avg(CASE WHEN o_orderstatus <> 'F' THEN {c} END), 6) AS mean_neg FROM {WIDE_SQL} x"
    for c in LAB_COLS + ["o_totalprice"])


def q_P13(spark, d):
    li = Tables(spark, d).lineitem
    return r6(sel.add_prefix(li, "lab_", LAB_COLS))


SQL_P13 = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, " + ", ".join(f"round({c}, 6) AS lab_{c}" for c in LAB_COLS)
           + ", l_returnflag, l_linestatus, l_shipdate FROM lineitem")


def q_P14(spark, d):
    doc = Tables(spark, d).documents.select("doc_id", "text")
    return sel.ascii_fold(doc, ["text"])


SQL_P14 = "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text FROM documents"


# --- I / D: cleaning, scaling, encoding -----------------------------------------

def q_I01(spark, d):
    return r6(clean.clean_data(wide(Tables(spark, d)), keys=["o_custkey", "o_orderkey"]))


_I01_NUM = [c for c in WIDE_NUM if c not in ("o_custkey", "o_orderkey")]
_I01_TXT = ["o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "l_returnflag", "l_linestatus"]


def _sql_mode(c, src):
    return (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


SQL_I01 = (f"WITH w AS (SELECT DISTINCT * FROM {WIDE_SQL} x) SELECT "
           + ", ".join(
               (f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM w)), 6) AS {c}" if c in DBL else
                f"coalesce({c}, CAST((SELECT quantile_cont({c}, 0.5) FROM w) AS {('INTEGER' if c in ('c_nationkey', 'l_linenumber') else 'BIGINT')})) AS {c}")
               if c in _I01_NUM else
               (f"coalesce({c}, {_sql_mode(c, 'w')}) AS {c}" if c in _I01_TXT else c)
               for c in WIDE_COLS)
           + " FROM w WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL")


def q_I02(spark, d):
    return r6(clean.handle_missing(wide(Tables(spark, d)), "mean", cat_fill_value="UNKNOWN"))


SQL_I02 = ("SELECT " + ", ".join(
    (f"round(coalesce({c}, (SELECT avg({c}) FROM {WIDE_SQL} z)), 6) AS {c}" if c in DBL else
     f"coalesce({c}, CAST((SELECT avg({c}) FROM {WIDE_SQL} z) AS {('INTEGER' if c in ('c_nationkey', 'l_linenumber') else 'BIGINT')})) AS {c}")
    if c in WIDE_NUM else (f"coalesce({c}, 'UNKNOWN') AS {c}" if c in _I01_TXT else c)
    for c in WIDE_COLS) + f" FROM {WIDE_SQL} x")


def _sql_fill(num, integer):
    """I02 with a fill of numeric columns: SQL of the fill by column, and how it becomes an integer."""
    def one(c):
        if c in _I01_TXT:
            return f"coalesce({c}, 'UNKNOWN') AS {c}"
        if c not in WIDE_NUM:
            return c
        if c in DBL:
            return f"round(coalesce({c}, {num(c)}), 6) AS {c}"
        return f"coalesce({c}, CAST({integer(num(c))} AS {'INTEGER' if c in ('c_nationkey', 'l_linenumber') else 'BIGINT'})) AS {c}"
    return "SELECT " + ", ".join(one(c) for c in WIDE_COLS) + f" FROM {WIDE_SQL} x"


def q_I02_median(spark, d):
    return r6(clean.handle_missing(wide(Tables(spark, d)), "median"))


SQL_I02_median = _sql_fill(lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM {WIDE_SQL} z)", lambda v: f"floor({v} + 0.5)")


def q_I02_most_frequent(spark, d):
    return r6(clean.handle_missing(wide(Tables(spark, d)), "most_frequent"))


SQL_I02_most_frequent = _sql_fill(
    lambda c: f"(SELECT {c} FROM {WIDE_SQL} z WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)", lambda v: v)


def q_I02_constant(spark, d):
    return r6(clean.handle_missing(wide(Tables(spark, d)), "constant", fill_value=-1.0, cat_fill_value="NONE"))


SQL_I02_constant = _sql_fill(lambda c: "-1.0", lambda v: v).replace("'UNKNOWN'", "'NONE'")


def q_I03(spark, d):
    li = Tables(spark, d).lineitem
    return r6(scale.standard_scale(li, LAB_COLS))


SQL_I03 = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in LAB_COLS)
           + ", l_returnflag, l_linestatus, l_shipdate FROM lineitem")


def q_I04(spark, d):
    a = adm(Tables(spark, d))
    return r6(scale.one_hot(a, ["o_orderpriority", "o_orderstatus", "c_mktsegment"]))


_I04_VALS = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
             "o_orderstatus": ["F", "O", "P"],
             "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}
SQL_I04 = ("SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, o_orderdate, c_custkey, c_name, "
           "c_nationkey, round(c_acctbal, 6) AS c_acctbal, "
           + ", ".join(f"CAST(coalesce({c} = '{v}', false) AS TINYINT) AS \"{c}_{v}\"" for c, vs in _I04_VALS.items()
                       for v in vs) + f" FROM {ADM_SQL} x")


def q_I05(spark, d):
    w = wide(Tables(spark, d)).select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return scale.fill_empty_text(w, ["l_returnflag"])


SQL_I05 = f"SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_returnflag, '') AS l_returnflag FROM {WIDE_SQL} x"


def q_D01(spark, d):
    li = Tables(spark, d).lineitem.withColumn("skewed", F.exp(F.col("l_quantity") / 10))
    return r6(clean.iqr_filter(li, ["l_extendedprice", "skewed"]))


def _sql_iqr_bounds(c, src):
    return (f"(SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {src})",
            f"(SELECT quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {src})")


_SK = "(SELECT *, exp(l_quantity / 10) AS skewed FROM lineitem)"
SQL_D01 = (f"SELECT {LI_SEL}, round(skewed, 6) AS skewed FROM {_SK} s WHERE "
           + " AND ".join(f"{c} BETWEEN {_sql_iqr_bounds(c, _SK)[0]} AND {_sql_iqr_bounds(c, _SK)[1]}"
                          for c in ["l_extendedprice", "skewed"]))


def q_D01_by_group(spark, d):
    li = Tables(spark, d).lineitem
    return r6(clean.iqr_filter(li, ["l_extendedprice", "l_quantity"], by=["l_returnflag"]))


SQL_D01_by_group = (f"SELECT {_sel(LI_COLS, 'l.')} FROM lineitem l JOIN (SELECT l_returnflag AS g, "
                    + ", ".join(f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
                                f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
                                for c in ["l_extendedprice", "l_quantity"])
                    + " FROM lineitem GROUP BY l_returnflag) b ON l.l_returnflag = b.g WHERE "
                    + " AND ".join(f"l.{c} BETWEEN lo_{c} AND hi_{c}" for c in ["l_extendedprice", "l_quantity"]))


def q_D02(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          F.exp(F.col("l_quantity") / 10).alias("skewed"),
                                          F.exp(F.col("l_quantity") / 5).alias("very_skewed"))
    out, _ = scale.log_transform_skewed(li, ["l_quantity", "skewed", "very_skewed"], threshold=1.0)
    return r6(out)


def _sql_log_if_skewed(c, src):
    m = f"(SELECT avg({c}) FROM {src})"
    skew = (f"(SELECT avg(power({c} - {m}, 3)) / power(avg(power({c} - {m}, 2)), 1.5) FROM {src})")
    return f"round(CASE WHEN abs({skew}) > 1.0 AND (SELECT min({c}) FROM {src}) >= 0 THEN ln(1 + {c}) ELSE {c} END, 6) AS {c}"


_SK2 = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, exp(l_quantity / 10) AS skewed, exp(l_quantity / 5) AS very_skewed FROM lineitem)"
SQL_D02 = ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
           + ", ".join(_sql_log_if_skewed(c, _SK2) for c in ["l_quantity", "skewed", "very_skewed"]) + f" FROM {_SK2} s")


def q_D03(spark, d):
    return r6(scale.minmax_scale(Tables(spark, d).lineitem, LAB_COLS))


SQL_D03 = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in LAB_COLS)
           + ", l_returnflag, l_linestatus, l_shipdate FROM lineitem")


def q_D04(spark, d):
    return r6(scale.robust_scale(Tables(spark, d).lineitem, LAB_COLS))


SQL_D04 = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           + ", ".join(f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / "
                       f"(SELECT CASE WHEN q3 = q1 THEN 1 ELSE q3 - q1 END FROM (SELECT quantile_cont({c}, 0.25) q1, "
                       f"quantile_cont({c}, 0.75) q3 FROM lineitem)), 6) AS {c}" for c in LAB_COLS)
           + ", l_returnflag, l_linestatus, l_shipdate FROM lineitem")


def q_D05(spark, d):
    e = Tables(spark, d).events
    return r6(tm.time_series(e, "ts", "day", ["event_type"], "value"))


SQL_D05 = ("SELECT date_trunc('day', ts) AS bucket, event_type, count(*) AS n, round(avg(value), 6) AS value_mean, "
           "round(quantile_cont(value, 0.5), 6) AS value_median FROM events GROUP BY 1, 2")


# --- A: aggregations ---------------------------------------------------------------

def q_A01(spark, d):
    return r6(clean.missing_counts(wide(Tables(spark, d))))


SQL_A01 = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percentage FROM {WIDE_SQL} x" for c in WIDE_COLS)


def q_A13(spark, d):
    m = clean.missing_counts(wide(Tables(spark, d)))
    return r6(sel.top_k(m, "missing_percentage", 20, ["column"]))


SQL_A13 = f"SELECT * FROM ({SQL_A01}) m ORDER BY missing_percentage DESC, \"column\" ASC LIMIT 20"


def q_A02(spark, d):
    return r6(stats.distributions(wide(Tables(spark, d)), LAB_COLS + ["o_totalprice", "c_acctbal"]))


SQL_A02 = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {WIDE_SQL} x"
    for c in LAB_COLS + ["o_totalprice", "c_acctbal"])


def q_A05(spark, d):
    q = quantiles(wide(Tables(spark, d)), LAB_COLS + ["o_totalprice"], {"median": 0.5})
    return r6(q)


SQL_A05 = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.5), 6) AS median FROM {WIDE_SQL} x"
                             for c in LAB_COLS + ["o_totalprice"])


def q_A06(spark, d):
    return clean.column_modes(wide(Tables(spark, d)), _I01_TXT)


SQL_A06 = " UNION ALL ".join(
    f"(SELECT '{c}' AS \"column\", {c} AS mode, count(*) AS mode_count FROM {WIDE_SQL} x WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)" for c in _I01_TXT)


def q_A07(spark, d):
    li = Tables(spark, d).lineitem
    return r6(stats.cluster_stats(li, "l_returnflag", LAB_COLS))


SQL_A07 = " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"count(*) AS size FROM lineitem GROUP BY l_returnflag" for c in LAB_COLS)


def q_A08(spark, d):
    o = Tables(spark, d).orders.withColumn("target", is_final())
    return stats.contingency(o, "o_orderpriority", "target")


SQL_A08 = ("SELECT o_orderpriority AS value, CAST(o_orderstatus = 'F' AS INTEGER) AS target, count(*) AS count "
           "FROM orders GROUP BY 1, 2")


def q_A09(spark, d):
    w = wide(Tables(spark, d))
    return r6(stats.stability_metrics(w, LAB_COLS))


def _sql_moments(c, src):
    m = f"(SELECT avg({c}) FROM {src})"
    m2 = f"avg(power({c} - {m}, 2))"
    return (f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(avg(power({c} - {m}, 3)) / power({m2}, 1.5), 6) AS skew, "
            f"round(avg(power({c} - {m}, 4)) / power({m2}, 2) - 3, 6) AS kurtosis, "
            f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio FROM {src} x")


SQL_A09 = " UNION ALL ".join(_sql_moments(c, WIDE_SQL) for c in LAB_COLS)


def q_A10(spark, d):
    return r6(stats.class_weights(Tables(spark, d).orders, "o_orderstatus"))


SQL_A10 = ("SELECT o_orderstatus AS label, count(*) AS count, "
           "round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders) * count(*)), 6) AS weight "
           "FROM orders GROUP BY o_orderstatus")


def q_A12(spark, d):
    return stats.distinct_values(Tables(spark, d).orders, "o_orderpriority")


SQL_A12 = "SELECT DISTINCT o_orderpriority FROM orders"


def q_A14(spark, d):
    li = Tables(spark, d).lineitem
    return r6(stats.histogram(li, ["l_extendedprice", "l_quantity"], 50))


SQL_A14 = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_hi,
  count(*) AS count, round(count(*) / (n * (hi - lo) / 50), 6) AS density
FROM (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, lo, hi, n
      FROM lineitem, (SELECT min({c}) lo, max({c}) hi, count({c}) n FROM lineitem) r WHERE {c} IS NOT NULL) b
GROUP BY bin, lo, hi, n""" for c in ["l_extendedprice", "l_quantity"])


def q_A15(spark, d):
    w = wide(Tables(spark, d)).withColumn("target", is_final())
    return r6(stats.box_stats(w, ["o_totalprice", "l_extendedprice"], "target"))


SQL_A15 = " UNION ALL ".join(f"""
SELECT target, '{c}' AS "column", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_lo,
  round(max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS target, {c} AS v FROM {WIDE_SQL} x WHERE {c} IS NOT NULL) b
JOIN (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS t, quantile_cont({c}, 0.25) q1, quantile_cont({c}, 0.5) med,
      quantile_cont({c}, 0.75) q3 FROM {WIDE_SQL} y WHERE {c} IS NOT NULL GROUP BY 1) q ON b.target = q.t
GROUP BY target, q1, med, q3""" for c in ["o_totalprice", "l_extendedprice"])


# --- R: correlation, tests, selection ----------------------------------------------

CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_R01(spark, d):
    return r6(stats.corr_matrix(Tables(spark, d).lineitem, CORR_COLS))


def _sql_corr_long(cols, src):
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0 AS r")
            else:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM {src} x")
    return " UNION ALL ".join(parts)


SQL_R01 = _sql_corr_long(CORR_COLS, "lineitem")


def q_R02(spark, d):
    return r6(stats.corr_matrix(Tables(spark, d).lineitem, CORR_COLS, "spearman"))


_RANKED = ("(SELECT " + ", ".join(
    f"(rank() OVER (ORDER BY {c}) + rank() OVER (ORDER BY {c}) + count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
    for c in CORR_COLS) + " FROM lineitem)")
SQL_R02 = _sql_corr_long(CORR_COLS, _RANKED)


def q_R03(spark, d):
    w = wide(Tables(spark, d)).withColumn("target", is_final())
    return r6(stats.welch_tests(w, "target", LAB_COLS + ["c_acctbal"]))


# The p-value integrates the density of t by Simpson's rule over 2,000 steps.
_R03_STATS = " UNION ALL ".join(f"""
SELECT (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t, power(v1 / n1 + v0 / n0, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v0 / n0, 2) / (n0 - 1)) AS v, '{c}' AS "column", n1 AS n_pos, n0 AS n_neg, round(m1, 6) AS mean_pos, round(m0, 6) AS mean_neg,
  round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t_stat,
  round(power(v1 / n1 + v0 / n0, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v0 / n0, 2) / (n0 - 1)), 6) AS dof,
  round((m1 - m0) / sqrt((v1 + v0) / 2), 6) AS cohens_d
FROM (SELECT count({c}) FILTER (WHERE t = 1) n1, avg({c}) FILTER (WHERE t = 1) m1, var_samp({c}) FILTER (WHERE t = 1) v1,
             count({c}) FILTER (WHERE t = 0) n0, avg({c}) FILTER (WHERE t = 0) m0, var_samp({c}) FILTER (WHERE t = 0) v0
      FROM (SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS t FROM {WIDE_SQL} x) y) s""" for c in LAB_COLS + ["c_acctbal"])
SQL_R03 = f"""
SELECT "column", n_pos, n_neg, mean_pos, mean_neg, t_stat, dof, cohens_d,
  round(greatest(0.0, 1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * power(1 + power(t * i / 2000.0, 2) / v, -(v + 1) / 2))
    * abs(t) / 6000.0 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())), 6) AS p_value
FROM ({_R03_STATS}) s, range(2001) r(i) GROUP BY ALL_COLUMNS
""".replace("ALL_COLUMNS", '"column", n_pos, n_neg, mean_pos, mean_neg, t_stat, dof, cohens_d, t, v')


def q_R04(spark, d):
    a = adm(Tables(spark, d)).withColumn("target", is_final())
    return r6(stats.chi2_tests(a, "target", ["o_orderpriority", "c_mktsegment", "c_nationkey"]))


def _sql_chi2(c):
    return f"""
SELECT '{c}' AS "column", round(sum(t0 + t1), 6) AS chi2, CAST(dof AS BIGINT) AS dof,
  round(sqrt(sum(t0 + t1) / (n * (least(r, nc) - 1))), 6) AS cramers_v, sum(t0 + t1) / 2 AS half, dof AS d
FROM (SELECT *, CASE WHEN e0 > 0 THEN power(abs(o0 - e0) - CASE WHEN dof = 1 THEN least(0.5, abs(o0 - e0)) ELSE 0 END, 2) / e0 ELSE 0 END AS t0,
                CASE WHEN e1 > 0 THEN power(abs(o1 - e1) - CASE WHEN dof = 1 THEN least(0.5, abs(o1 - e1)) ELSE 0 END, 2) / e1 ELSE 0 END AS t1
      FROM (SELECT *, (o0 + o1) * c0 / n AS e0, (o0 + o1) * c1 / n AS e1, (r - 1) * (nc - 1) AS dof
            FROM (SELECT *, sum(o0) OVER () AS c0, sum(o1) OVER () AS c1, sum(o0 + o1) OVER () AS n, count(*) OVER () AS r,
                         CAST(sum(o0) OVER () > 0 AS INTEGER) + CAST(sum(o1) OVER () > 0 AS INTEGER) AS nc
                  FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) FILTER (WHERE o_orderstatus <> 'F') AS o0,
                               count(*) FILTER (WHERE o_orderstatus = 'F') AS o1
                        FROM {ADM_SQL} x WHERE {c} IS NOT NULL GROUP BY 1) a) b) e) f
GROUP BY dof, n, r, nc"""


# With an even number of degrees of freedom the tail is a finite Poisson sum.
SQL_R04 = f"""
SELECT "column", chi2, dof, cramers_v, round(exp(-half) * sum(CASE WHEN 2 * i < d THEN power(half, i) / gamma(i + 1.0) ELSE 0 END), 6) AS p_value
FROM ({" UNION ALL ".join(_sql_chi2(c) for c in ["o_orderpriority", "c_mktsegment", "c_nationkey"])}) s, range(50) r(i)
GROUP BY "column", chi2, dof, cramers_v, half, d
"""


SEL_COLS = ["o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "c_acctbal", "l_linenumber",
            "c_nationkey"]


def _sel_table(t):
    return wide(t).where(F.col("l_orderkey").isNotNull()).withColumn("target", (F.col("l_returnflag") == "R").cast("int"))


_SEL_SQL = f"(SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS target FROM {WIDE_SQL} x WHERE l_orderkey IS NOT NULL)"


def q_R05(spark, d):
    return r6(stats.target_correlation(_sel_table(Tables(spark, d)), "target", SEL_COLS))


SQL_R05 = " UNION ALL ".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, target)), 6) AS abs_corr FROM {_SEL_SQL} s"
                             for c in SEL_COLS)


def q_R06(spark, d):
    li = fe.interactions(Tables(spark, d).lineitem, ["l_quantity", "l_discount", "l_tax"])
    cols = [c for c in li.columns if c.startswith("interaction_")] + ["l_quantity", "l_extendedprice"]
    return r6(stats.high_correlation_pairs(li, cols, 0.8))


def q_R07(spark, d):
    return r6(stats.mutual_information(_sel_table(Tables(spark, d)), "target", SEL_COLS, bins=10))


SQL_R07 = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 6) AS mutual_info
FROM (SELECT nxy, sum(nxy) OVER (PARTITION BY b) AS nx, sum(nxy) OVER (PARTITION BY y) AS ny, sum(nxy) OVER () AS n
      FROM (SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor(({c} - lo) / (hi - lo) * 10), 9) END AS b, target AS y, count(*) AS nxy
            FROM {_SEL_SQL} s, (SELECT min({c}) lo, max({c}) hi FROM {_SEL_SQL} s2 WHERE {c} IS NOT NULL) r
            WHERE {c} IS NOT NULL GROUP BY 1, 2) c) m""" for c in SEL_COLS)


def q_O03(spark, d):
    """Top-3 features by |corr| with the target (the projection itself is
    ``stats.select_features``)."""
    sc = stats.target_correlation(_sel_table(Tables(spark, d)), "target", SEL_COLS)
    return r6(sel.top_k(sc, "abs_corr", 3, ["feature"]))


def q_O03(spark, d):
    """The projection on the three features with the highest |corr|, told by
    each column's count and range."""
    df, names = stats.select_features(_sel_table(Tables(spark, d)), "target", SEL_COLS, k=3)
    return r6(stats.melt(df, names).groupBy(F.col("column").alias("feature")).agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")))


_O03_RANGES = " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, round(min({c}), 6)::DOUBLE AS lo, round(max({c}), 6)::DOUBLE AS hi FROM {_SEL_SQL} s"
                                 for c in SEL_COLS)
SQL_O03 = f"SELECT r.* FROM ({_O03_RANGES}) r JOIN (SELECT feature FROM ({SQL_R05}) s ORDER BY abs_corr DESC, feature LIMIT 3) b USING (feature)"

_R06_SRC = ("(SELECT l_quantity * l_quantity AS \"interaction_l_quantity^2\", l_quantity * l_discount AS \"interaction_l_quantity l_discount\", "
            "l_quantity * l_tax AS \"interaction_l_quantity l_tax\", l_discount * l_discount AS \"interaction_l_discount^2\", "
            "l_discount * l_tax AS \"interaction_l_discount l_tax\", l_tax * l_tax AS \"interaction_l_tax^2\", "
            "l_quantity, l_extendedprice FROM lineitem)")
_R06_COLS = ["interaction_l_quantity^2", "interaction_l_quantity l_discount", "interaction_l_quantity l_tax",
             "interaction_l_discount^2", "interaction_l_discount l_tax", "interaction_l_tax^2", "l_quantity",
             "l_extendedprice"]
SQL_R06 = ("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(\"{a}\", \"{b}\"), 6) AS r FROM {_R06_SRC} x"
    for a in _R06_COLS for b in _R06_COLS if a != b) + ") p WHERE abs(r) > 0.8")


# --- O / U: order, sampling, splits, set operations -------------------------------

def q_O01(spark, d):
    return q_A13(spark, d)


SQL_O01 = SQL_A13


def q_O02(spark, d):
    sc = stats.target_correlation(_sel_table(Tables(spark, d)), "target", SEL_COLS).withColumnRenamed(
        "abs_corr", "importance")
    return r6(sel.top_k(sc, "importance", 5, ["feature"]))


SQL_O02 = f"SELECT feature, abs_corr AS importance FROM ({SQL_R05}) s ORDER BY abs_corr DESC, feature LIMIT 5"


def q_O04(spark, d):
    return r6(sel.sample_n(Tables(spark, d).orders, 1000, ["o_orderkey"], seed=42))


SQL_O04 = (f"SELECT {_sel(ORD_COLS)} FROM orders ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), "
           "o_orderkey LIMIT 1000")


def q_O05(spark, d):
    return r6(sel.sample_n(Tables(spark, d).events, 100, ["event_id"], seed=7))


SQL_O05 = (f"SELECT {EV_SEL} FROM events ORDER BY md5(concat_ws('|', '7', CAST(event_id AS VARCHAR))), event_id LIMIT 100")


def q_O06(spark, d):
    b = sel.bootstrap(Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), 20, ["o_orderkey"], seed=42)
    return r6(b.groupBy("replicate").agg(F.sum("weight").cast("int").alias("n"),
                                         (F.sum(F.col("weight") * F.col("o_totalprice")) / F.sum("weight")).alias("mean_price")))


def _sql_poisson(u):
    cdf = sel.poisson1_cdf(16)
    return "CASE " + " ".join(f"WHEN {u} < {c!r} THEN {k}" for k, c in enumerate(cdf)) + " ELSE 16 END"


_U_SQL = "CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(r AS VARCHAR), CAST(o_orderkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0"
SQL_O06 = f"""
SELECT CAST(r AS INTEGER) AS replicate, CAST(sum(w) AS INTEGER) AS n, round(sum(w * o_totalprice) / sum(w), 6) AS mean_price
FROM (SELECT r, o_orderkey, o_totalprice, {_sql_poisson(_U_SQL)} AS w
      FROM orders, (SELECT unnest(range(20)) AS r) g) b WHERE w > 0 GROUP BY r
"""


def q_O07(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return sel.stratified_split(o, "o_orderstatus", ["o_orderkey"], 0.8, seed=42)


SQL_O07 = """
SELECT o_orderkey, o_orderstatus, CASE WHEN rn < floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split
FROM (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1 AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) r
"""


def q_O08(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return sel.stratified_folds(o, "o_orderstatus", ["o_orderkey"], 3, seed=42)


SQL_O08 = """
SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
       ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 3 AS INTEGER) AS fold FROM orders
"""


def q_U01(spark, d):
    li = Tables(spark, d).lineitem
    return r6(sel.drop_duplicates(li.unionByName(li)))


SQL_U01 = f"SELECT DISTINCT {LI_SEL} FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem) u"


def _two_rankings(t):
    base = _sel_table(t).withColumn("target_b", is_final())
    a = stats.target_correlation(base, "target", SEL_COLS).withColumnRenamed("abs_corr", "importance")
    b = stats.target_correlation(base, "target_b", SEL_COLS).withColumnRenamed("abs_corr", "importance")
    return a, b


def q_U02(spark, d):
    a, b = _two_rankings(Tables(spark, d))
    return sel.common_top(a, b, 5)


_SEL_SQL_B = f"(SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS target_b FROM {_SEL_SQL} s0)"
_RANK_A = " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, target)) AS importance FROM {_SEL_SQL_B} s" for c in SEL_COLS)
_RANK_B = " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, target_b)) AS importance FROM {_SEL_SQL_B} s" for c in SEL_COLS)
SQL_U02 = (f"(SELECT feature FROM ({_RANK_A}) a ORDER BY importance DESC, feature LIMIT 5) INTERSECT "
           f"(SELECT feature FROM ({_RANK_B}) b ORDER BY importance DESC, feature LIMIT 5)")


def q_X09_rankings(spark, d):
    """X09 on data-derived rankings: Spearman correlation between features'
    |corr| with two different targets."""
    a, b = _two_rankings(Tables(spark, d))
    return r6(xp.compare_explanations(a, b))


SQL_X09_rankings = f"""
SELECT round(corr(ra, rb), 6) AS spearman, count(*) AS n_features FROM (
  SELECT (rank() OVER (ORDER BY a.importance) + rank() OVER (ORDER BY a.importance)
          + count(*) OVER (PARTITION BY a.importance) - 1) / 2.0 AS ra,
         (rank() OVER (ORDER BY b.importance) + rank() OVER (ORDER BY b.importance)
          + count(*) OVER (PARTITION BY b.importance) - 1) / 2.0 AS rb
  FROM ({_RANK_A}) a JOIN ({_RANK_B}) b ON a.feature = b.feature) r
"""


def q_U03(spark, d):
    li = Tables(spark, d).lineitem
    extra = li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")
    return r6(sel.append_rows(li, extra))


SQL_U03 = (f"SELECT {LI_SEL} FROM lineitem UNION ALL SELECT l_orderkey, NULL, NULL, l_linenumber, round(l_quantity, 6), "
           "NULL, NULL, NULL, NULL, NULL, NULL FROM lineitem WHERE l_returnflag = 'R'")


def q_S12(spark, d):
    """Report table: both rankings, full outer joined on feature, with ranks
    and the in-both-top-5 flag; features in either top 10."""
    from cohortkit.operators.interpret import importance_report
    a, b = _two_rankings(Tables(spark, d))
    return r6(importance_report(a, b, top=10, common=5))


SQL_S12 = f"""
WITH a AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank_a FROM ({_RANK_A}) x),
     b AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank_b FROM ({_RANK_B}) y)
SELECT coalesce(a.feature, b.feature) AS feature, round(a.importance, 6) AS importance_a, CAST(a.rank_a AS INTEGER) AS rank_a,
       round(b.importance, 6) AS importance_b, CAST(b.rank_b AS INTEGER) AS rank_b,
       coalesce(a.rank_a <= 5 AND b.rank_b <= 5, false) AS in_both_top5
FROM a FULL OUTER JOIN b ON a.feature = b.feature WHERE a.rank_a <= 10 OR b.rank_b <= 10
"""


# --- E: evaluation of a scored table ------------------------------------------------

def q_A11(spark, d):
    return ev.confusion(scored(Tables(spark, d)))


SQL_A11 = (f"SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
           f"count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM {SCORED_SQL} s")


def q_E01(spark, d):
    return r6(ev.classification_metrics(scored(Tables(spark, d))).drop("f2"))


_CM = f"(SELECT CAST(tp AS DOUBLE) tp, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tn AS DOUBLE) tn FROM ({SQL_A11}) c)"
_PREC = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END"
_REC = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END"
SQL_E01 = (f"SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall, "
           f"round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM (SELECT *, {_PREC} AS p, {_REC} AS r FROM {_CM} c) m")


def q_E02(spark, d):
    return r6(ev.classification_metrics(scored(Tables(spark, d)), beta=2.0).select("f2"))


SQL_E02 = f"SELECT round(CASE WHEN 4 * p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0 END, 6) AS f2 FROM (SELECT *, {_PREC} AS p, {_REC} AS r FROM {_CM} c) m"


def q_E03(spark, d):
    return r6(ev.roc_auc(scored(Tables(spark, d))))


SQL_E03 = f"""
SELECT round((sum(CASE WHEN label = 1 THEN rk END) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) AS roc_auc
FROM (SELECT label, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk,
             count(*) FILTER (WHERE label = 1) OVER () AS n1, count(*) FILTER (WHERE label <> 1) OVER () AS n0 FROM {SCORED_SQL} s) r
GROUP BY n1, n0
"""


def _sql_score_table(src):
    return f"""(SELECT threshold, pos, neg, tp - pos AS tp0, fp - neg AS fp0, tp, fp, P, N FROM
  (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
          sum(pos) OVER () AS P, sum(neg) OVER () AS N
   FROM (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
         FROM {src} s WHERE score IS NOT NULL GROUP BY score) g) c)"""


def q_E04(spark, d):
    return r6(ev.pr_auc(scored(Tables(spark, d))))


SQL_E04 = (f"SELECT round(sum(pos / P * (tp / (tp + fp) + CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2), 6) AS pr_auc "
           f"FROM {_sql_score_table(SCORED_SQL)} t WHERE tp0 < P")


def q_E05(spark, d):
    return r6(ev.roc_curve(scored(Tables(spark, d))))


SQL_E05 = (f"SELECT CAST(threshold AS DOUBLE) AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM {_sql_score_table(SCORED_SQL)} t "
           "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0")


def q_E06(spark, d):
    return r6(ev.pr_curve(scored(Tables(spark, d))))


SQL_E06 = (f"SELECT CAST(threshold AS DOUBLE) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall "
           f"FROM {_sql_score_table(SCORED_SQL)} t WHERE tp0 < P")


def q_E07(spark, d):
    return r6(ev.calibration_curve(scored(Tables(spark, d))))


SQL_E07 = ("SELECT CAST(" + " + ".join(f"CAST(score > {e!r} AS INTEGER)" for e in ev.CALIBRATION_EDGES)
           + f" AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive "
           f"FROM {SCORED_SQL} s WHERE score IS NOT NULL GROUP BY 1")


def q_E08(spark, d):
    t = Tables(spark, d)
    m = [ev.evaluate(s).withColumn("model", F.lit(name)) for name, s in (("length", scored(t)), ("modulo", scored_b(t)))]
    tab = ev.compare_models(m[0].unionByName(m[1]).drop("f2"), "model")
    return r6(tab)


def _sql_metrics(src):
    cm = (f"(SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) tp, CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) fp, "
          f"CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) fn, CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) tn FROM {src} s)")
    auc = (f"(SELECT sum(neg * (tp0 + 0.5 * pos)) / (max(P) * max(N)) FROM {_sql_score_table(src)} t)")
    pra = (f"(SELECT sum(pos / P * (tp / (tp + fp) + CASE WHEN tp0 + fp0 = 0 THEN 1.0 ELSE tp0 / (tp0 + fp0) END) / 2) "
           f"FROM {_sql_score_table(src)} t WHERE tp0 < P)")
    return (f"SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, p AS precision, r AS recall, "
            f"CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1, {auc} AS roc_auc, {pra} AS pr_auc "
            f"FROM (SELECT *, {_PREC} AS p, {_REC} AS r FROM {cm} c) m")


SQL_E08 = f"""
WITH a AS ({_sql_metrics(SCORED_SQL)}), b AS ({_sql_metrics(SCORED_B_SQL)}),
la AS (UNPIVOT a ON accuracy, precision, recall, f1, roc_auc, pr_auc INTO NAME metric VALUE v),
lb AS (UNPIVOT b ON accuracy, precision, recall, f1, roc_auc, pr_auc INTO NAME metric VALUE v)
SELECT la.metric, round(la.v, 6) AS length, round(lb.v, 6) AS modulo FROM la JOIN lb ON la.metric = lb.metric
"""


def q_W04(spark, d):
    return ev.score_table(scored(Tables(spark, d))).select("threshold", "pos", "neg", "tp", "fp").transform(r6)


SQL_W04 = f"SELECT round(threshold, 6) AS threshold, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM {_sql_score_table(SCORED_SQL)} t"


def q_W05(spark, d):
    return r6(average_rank(Tables(spark, d).lineitem, "l_extendedprice", name="rank").drop("_ck_ties"))


SQL_W05 = ("SELECT DISTINCT round(l_extendedprice, 6) AS l_extendedprice, "
           "(rank() OVER (ORDER BY l_extendedprice) + rank() OVER (ORDER BY l_extendedprice) + count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rank FROM lineitem")


# --- F08–F10, T01: lab flags, interactions, text --------------------------------------

def _items(li):
    item = (F.when(F.col("l_linenumber") == 1, 50809).when(F.col("l_linenumber") == 2, 50810)
            .when(F.col("l_linenumber") == 3, 50811).when(F.col("l_linenumber") == 4, 50822)
            .when(F.col("l_linenumber") == 5, 50931).otherwise(F.col("l_linenumber")).cast("long"))
    return li.withColumn("itemid", item)


def q_F08(spark, d):
    li = _items(Tables(spark, d).lineitem)
    return r6(lab.flag_abnormal(li, "itemid", "l_quantity", lab.lab_reference(spark)))


_REF_SQL = ("(VALUES (50809, 70.0, 100.0), (50810, 0.6, 1.2), (50811, 12.0, 16.0), (50822, 3.5, 5.0), "
            "(50931, 4.5, 11.0)) AS r(itemid, lo, hi)")
SQL_F08 = (f"SELECT {LI_SEL}, li.itemid, CASE WHEN r.itemid IS NULL THEN NULL ELSE coalesce(l_quantity < lo OR l_quantity > hi, false) END AS is_abnormal "
           "FROM (SELECT *, CAST(CASE l_linenumber WHEN 1 THEN 50809 WHEN 2 THEN 50810 WHEN 3 THEN 50811 WHEN 4 THEN 50822 "
           f"WHEN 5 THEN 50931 ELSE l_linenumber END AS BIGINT) AS itemid FROM lineitem) li LEFT JOIN {_REF_SQL} ON li.itemid = r.itemid")


def q_F09(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("lab_qty"),
        (F.col("l_linenumber") * 5.0).alias("lab_qty_lower"), (F.col("l_linenumber") * 5.0 + 20).alias("lab_qty_upper"))
    return r6(lab.bound_flags(li, ["lab_qty"]))


SQL_F09 = ("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS lab_qty, round(CAST(l_linenumber * 5.0 AS DOUBLE), 6) AS lab_qty_lower, "
           "round(CAST(l_linenumber * 5.0 + 20 AS DOUBLE), 6) AS lab_qty_upper, CAST(coalesce(l_quantity < l_linenumber * 5.0 OR l_quantity > l_linenumber * 5.0 + 20, false) AS INTEGER) "
           "AS lab_qty_is_abnormal FROM lineitem")


def q_F10(spark, d):
    # Products are single IEEE multiplications, identical in any engine;
    # rounding them would only add last-digit noise, so they stay exact.
    li = Tables(spark, d).lineitem
    out = fe.interactions(li, max_inputs=10)
    return out


_F10_IN = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SQL_F10 = (f"SELECT {', '.join(LI_COLS)}, " + ", ".join(
    f"CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS \"interaction_{a}^2\"" if a == b else
    f"CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS \"interaction_{a} {b}\""
    for i, a in enumerate(_F10_IN) for b in _F10_IN[i:]) + " FROM lineitem")


def q_T01(spark, d):
    doc = Tables(spark, d).documents.select("doc_id", "text")
    out = fe.tfidf_features(doc, "text", max_features=100)
    return r6(out.drop("text"))


def _sql_tfidf():
    from cohortkit.functions.text import TOKEN_PATTERN, english_stop_words
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())
    cols = ", ".join(f"round(coalesce(max(CASE WHEN idx = {i} THEN w END), 0) / coalesce(max(nrm), 1), 6) AS text_tfidf_{i}"
                     for i in range(100))
    return f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_PATTERN}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term NOT IN ({stop}) GROUP BY 1, 2),
st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
voc AS (SELECT term, df FROM st ORDER BY total DESC, term ASC LIMIT 100),
vi AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx,
              ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM voc),
wt AS (SELECT tf.doc_id, vi.idx, tf.tf * vi.idf AS w FROM tf JOIN vi ON tf.term = vi.term),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM wt GROUP BY doc_id)
SELECT d.doc_id, {cols}
FROM documents d LEFT JOIN wt ON d.doc_id = wt.doc_id LEFT JOIN nr ON d.doc_id = nr.doc_id GROUP BY d.doc_id
"""


# --- registry ------------------------------------------------------------------------

def _registry():
    g = globals()
    reg = {}
    for name, fn in list(g.items()):
        if name.startswith("q_") and callable(fn):
            key = name[2:]
            reg[key] = (fn, g.get(f"SQL_{key}"))
    reg["T01"] = (q_T01, _sql_tfidf())
    from cohortkit.plans import explained
    reg |= {name[2:]: (fn, getattr(explained, f"SQL_{name[2:]}", None)) for name, fn in vars(explained).items() if name.startswith("q_")}
    return reg


def queries() -> dict:
    return {k: v[0] for k, v in _registry().items()}


def _positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)`` so that a value
    rounding to zero from below is +0.0, as Spark's decimal rounding gives."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _positive_zero_rounds(sql[j + len(key):k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def oracle_sql() -> dict:
    return {k: _positive_zero_rounds(v[1]) for k, v in _registry().items() if v[1]}


# --- remaining inventory IDs -----------------------------------------------------------

def q_A04(spark, d):
    """Missing counts after imputation (mean / 'UNKNOWN'): only the
    timestamp column keeps its NULLs."""
    return r6(clean.missing_counts(clean.handle_missing(wide(Tables(spark, d)), "mean")))


SQL_A04 = " UNION ALL ".join(
    (f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
     f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percentage FROM {WIDE_SQL} x") if c == "l_shipdate" else
    f"SELECT '{c}' AS \"column\", CAST(0 AS BIGINT) AS missing_count, 0.0 AS missing_percentage"
    for c in WIDE_COLS)


def q_P10(spark, d):
    a = adm(Tables(spark, d))
    enc = scale.one_hot(a, ["o_orderstatus"], drop_source=False)
    return r6(sel.drop_columns(enc, ["o_orderstatus", "c_name"]))


SQL_P10 = ("SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority, c_custkey, "
           "c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment, "
           + ", ".join(f"CAST(coalesce(o_orderstatus = '{v}', false) AS TINYINT) AS o_orderstatus_{v}" for v in "FOP")
           + f" FROM {ADM_SQL} x")


def q_J04(spark, d):
    """Column-wise concatenation by key: admissions with their per-admission
    lab statistics (never by position)."""
    t = Tables(spark, d)
    g = lab.group_stats(t.lineitem, "l_orderkey", ["l_quantity"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return r6(joins.concat_columns(t.orders, g, ["o_orderkey"]))


SQL_J04 = (f"SELECT {_sel(ORD_COLS, 'o.')}, g.* EXCLUDE (l_orderkey) FROM orders o LEFT JOIN ("
           + _sql_group_stats("l_orderkey", ["l_quantity"], "lineitem") + ") g ON o.o_orderkey = g.l_orderkey")


def q_W03(spark, d):
    """Cumulative share of a distribution (the running-sum form behind the
    cumulative explained variance): histogram bins of l_extendedprice."""
    from pyspark.sql import Window
    h = stats.histogram(Tables(spark, d).lineitem, ["l_extendedprice"], 50)
    w = Window.partitionBy("column").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy("column")
    return r6(h.select("column", "bin", (F.sum("count").over(w) / F.sum("count").over(tot)).alias("cumulative")))


SQL_W03 = ("SELECT \"column\", bin, round(sum(count) OVER (PARTITION BY \"column\" ORDER BY bin) / sum(count) OVER (PARTITION BY \"column\"), 6) "
           "AS cumulative FROM (" + SQL_A14.split(" UNION ALL ")[0] + ") h")


def q_W03_pca(spark, d):
    """Explained and cumulative variance, and the components needed."""
    var, needed, _ = ml.pca_analysis(Tables(spark, d).lineitem, ["l_quantity", "l_extendedprice"])
    return r6(var.withColumn("n_components_95", F.lit(needed)))


# Two standardized columns of correlation r have the variances 1 + |r| and 1 - |r|.
SQL_W03_pca = """
SELECT CAST(1 AS INTEGER) AS component, round((1 + r) / 2, 6) AS explained_variance_ratio, round((1 + r) / 2, 6) AS cumulative,
  CAST(CASE WHEN (1 + r) / 2 >= 0.95 THEN 1 ELSE 2 END AS INTEGER) AS n_components_95
FROM (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem) a
UNION ALL
SELECT CAST(2 AS INTEGER), round((1 - r) / 2, 6), 1.0::DOUBLE, CAST(CASE WHEN (1 + r) / 2 >= 0.95 THEN 1 ELSE 2 END AS INTEGER)
FROM (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem) a
"""


def q_M03(spark, d):
    """Boosted trees."""
    _, _, metrics = ml.train_model(kept_admissions(spark, d), ADM_FEATURES, "gbt", "label", ["id"], seed=42)
    return r6(metrics.drop("train_seconds"))


def q_M04(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return r6(ml.with_class_weights(o, "o_orderstatus"))


SQL_M04 = ("SELECT o_orderkey, o_orderstatus, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders) "
           "* count(*) OVER (PARTITION BY o_orderstatus)), 6) AS weight FROM orders")


def q_M07(spark, d):
    data = kept_admissions(spark, d)
    model, scored_, metrics = ml.train_model(data, ADM_FEATURES, "logistic", "label", ["id"], seed=42)
    return r6(metrics.drop("train_seconds"))


def q_S02(spark, d):
    """Time columns parsed from text (unparseable → NULL): orders' date
    rendered as text, with one in three made unparseable, parsed back."""
    o = Tables(spark, d).orders
    txt = F.when(F.col("o_orderkey") % 3 == 0, F.lit("not a date")).otherwise(F.col("o_orderdate").cast("string"))
    return o.select("o_orderkey", tm.to_ts(txt).alias("o_orderdate"))


SQL_S02 = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders"


# --- sinks, read back (S03, S07–S11) -------------------------------------------------------

def _scratch(spark, name):
    import uuid
    from cohortkit.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/cohortkit-{name}-{uuid.uuid4().hex}"


def q_S07(spark, d):
    """Parquet table sink, read back."""
    from cohortkit.sources import sinks
    path = _scratch(spark, "s07")
    sinks.write_table(adm(Tables(spark, d)), path)
    return r6(spark.read.parquet(path))


SQL_S07 = SQL_J01


def q_S03(spark, d):
    """CSV table sink, read back with the time column parsed (S03 load)."""
    from cohortkit.sources import sinks, tables
    path = _scratch(spark, "s03")
    o = Tables(spark, d).orders
    sinks.write_table(o, path, "csv")
    # Declared schema (no inference pass); the time column arrives as text.
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "o_orderdate" else f.dataType)
                           for f in o.schema.fields])
    return r6(tables.load_with_times(spark, path, ["o_orderdate", "o_shipdate_absent"], schema=schema))


SQL_S03 = f"SELECT {_sel(ORD_COLS)} FROM orders"


def q_S08(spark, d):
    """Metrics sink (JSON lines), read back: class weights as metrics."""
    from cohortkit.sources import sinks
    path = _scratch(spark, "s08")
    w = stats.class_weights(Tables(spark, d).orders, "o_orderstatus")
    m = w.select(F.concat(F.lit("weight."), F.col("label")).alias("metric"), F.col("weight").alias("value"),
                 F.lit(None).cast("string").alias("text"))
    sinks.write_metrics(m, path)
    return r6(spark.read.schema("metric string, value double, text string").json(path))


SQL_S08 = ("SELECT 'weight.' || o_orderstatus AS metric, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) "
           "FROM orders) * count(*)), 6) AS value, CAST(NULL AS VARCHAR) AS text FROM orders GROUP BY o_orderstatus")


def q_S09(spark, d):
    """Feature-list sink and scan (S06): the top-3 selected features."""
    from cohortkit.sources import sinks
    path = _scratch(spark, "s09")
    sc = stats.target_correlation(_sel_table(Tables(spark, d)), "target", SEL_COLS)
    names = [r["feature"] for r in sel.top_k(sc, "abs_corr", 3, ["feature"]).collect()]
    sinks.write_feature_list(spark, names, path)
    return spark.createDataFrame([(n,) for n in sinks.read_feature_list(spark, path)], "feature string")


SQL_S09 = f"SELECT feature FROM ({SQL_R05}) s ORDER BY abs_corr DESC, feature LIMIT 3"


def q_S10(spark, d):
    """Importance sink (CSV), read back."""
    from cohortkit.sources import sinks
    path = _scratch(spark, "s10")
    sc = stats.target_correlation(_sel_table(Tables(spark, d)), "target", SEL_COLS).withColumnRenamed("abs_corr", "importance")
    sinks.write_importances(sc, path)
    return r6(spark.read.schema("feature string, importance double").option("header", True).csv(path))


SQL_S10 = f"SELECT feature, abs_corr AS importance FROM ({SQL_R05}) s"


def q_S11(spark, d):
    """Model save and load: the reloaded model scores like the original."""
    from cohortkit.sources import sinks
    model, data = _trained(spark, d, "logistic")
    path = _scratch(spark, "s11")
    sinks.save_model(model, path)
    again = sinks.load_model(path)
    a = ml.score(model, data).select("id", F.col("score").alias("s1"))
    b = ml.score(again, data).select("id", F.col("score").alias("s2"))
    return a.join(b, "id").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_diff"))


# --- Structured Streaming ---------------------------------------------------------------------

def q_stream_features(spark, d):
    """F02–F05 on a stream: the events table read with ``readStream``,
    features added per micro-batch, written (availableNow) to a Parquet sink
    in the checkpoint folder with its own streaming checkpoint, read back."""
    import os
    from cohortkit.streaming import features as sf
    schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    # A streaming file source watches a directory or a glob; the character
    # class makes a glob that matches exactly the one table file.
    stream = sf.read_stream(spark, os.path.join(d, "event[s].parquet"), schema, max_files_per_trigger=1)
    out = _scratch(spark, "stream")
    q = (sf.stream_features(stream, ["ts"]).writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return r6(spark.read.parquet(f"{out}/data"))


SQL_stream_features = f"SELECT {EV_SEL}, {', '.join(_TS_PARTS)} FROM events"


def q_stream_series(spark, d):
    """D05 on a stream: watermarked daily windows per event type.  The
    aggregate runs in complete mode and each micro-batch overwrites the
    Parquet result, so the last batch leaves the full table."""
    import os
    from cohortkit.streaming import features as sf
    schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    stream = sf.read_stream(spark, os.path.join(d, "event[s].parquet"), schema, max_files_per_trigger=1)
    stream = stream.withColumn("ts", tm.instant_of("ts"))  # watermarks need a zoned timestamp
    out = _scratch(spark, "series")
    series = sf.windowed_series(stream, "ts", "1 day", "1 day", ["event_type"], "value")

    def sink(batch, epoch):
        batch.select("bucket", "event_type", "n", "value_mean").write.mode("overwrite").parquet(f"{out}/data")

    sf.run_once(series, f"{out}/checkpoint", sink, output_mode="complete")
    res = spark.read.parquet(f"{out}/data")
    return r6(res.select(tm.wall_time_of("bucket").alias("bucket"), "event_type", "n", "value_mean"))


SQL_stream_series = ("SELECT date_trunc('day', ts) AS bucket, event_type, count(*) AS n, round(avg(value), 6) AS value_mean "
                     "FROM events GROUP BY 1, 2")


def _event_stream(spark, d):
    import os
    from cohortkit.streaming import features as sf
    schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    stream = sf.read_stream(spark, os.path.join(d, "event[s].parquet"), schema, max_files_per_trigger=1)
    return stream.withColumn("ts", tm.instant_of("ts"))


def _appended(spark, stream, name):
    """The rows a stateful stream appends to a Parquet sink until all input is read; what the watermark
    (one day behind the newest event) has not passed stays in the state, as it does while a stream runs."""
    from cohortkit.streaming.stateful import rocksdb_state
    out = _scratch(spark, name)
    with rocksdb_state(spark):
        q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{out}/data")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def q_stream_distinct(spark, d):
    """U01 on a stream with bounded state: users seen per day and event type."""
    from cohortkit.streaming import stateful as st
    days = _event_stream(spark, d).select(F.date_trunc("day", "ts").alias("bucket"), "event_type", "user_id")
    res = _appended(spark, st.distinct_within(days, "bucket", ["bucket", "event_type", "user_id"]), "distinct")
    return res.select(tm.wall_time_of("bucket").alias("bucket"), "event_type", "user_id")


SQL_stream_distinct = "SELECT DISTINCT date_trunc('day', ts) AS bucket, event_type, user_id FROM events WHERE ts IS NOT NULL"


def q_stream_trend(spark, d):
    """W01/W02 on a stream with one kept row per user: each event the watermark has passed, in event order."""
    from cohortkit.streaming import stateful as st
    res = _appended(spark, st.trend_stream(_event_stream(spark, d), "user_id", "ts", ["value"], ["event_id"]), "trend")
    return r6(res.withColumn("ts", tm.wall_time_of("ts")))


_PASSED = "(SELECT max(date_trunc('milliseconds', ts)) - INTERVAL 1 DAY AS wm FROM events) AS w"
SQL_stream_trend = (
    "SELECT user_id, ts, event_id, round(value, 6) AS value, round(diff, 6) + 0.0 AS value_trend, CAST(sign(diff) AS DOUBLE) AS value_trend_sign "
    "FROM (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS diff FROM events "
    f"WHERE user_id IS NOT NULL AND ts IS NOT NULL) AS e, {_PASSED} WHERE ts <= wm")


def q_stream_series_closed(spark, d):
    """D05 on a stream in append mode: every day and event type once, when the watermark has closed the day."""
    from cohortkit.streaming import stateful as st
    res = _appended(spark, st.closed_series(_event_stream(spark, d), "ts", "1 day", "1 day", ["event_type"], "value"), "closed")
    return r6(res.select(tm.wall_time_of("bucket").alias("bucket"), "event_type", "n", "value_mean"))


SQL_stream_series_closed = (f"SELECT s.* FROM ({SQL_stream_series}) AS s, {_PASSED} WHERE s.bucket + INTERVAL 1 DAY <= wm")


# --- M / X: models and explanations (rows-only: seeded, no SQL oracle) -------------------

ADM_FEATURES = ["o_totalprice", "c_acctbal", "n_lines", "qty_mean", "price_mean", "disc_mean", "share_f", "los_mean"]


def admission_table(t: Tables) -> DataFrame:
    """Training table: one row per admission, lab aggregates as features,
    label = final status (o_orderstatus = 'F').  Lab events are added up by
    admission before the join, so a hot admission is one row of it; an
    admission without them lacks features and is dropped as any incomplete one."""
    means = {"qty_mean": F.col("l_quantity"), "price_mean": F.col("l_extendedprice"), "disc_mean": F.col("l_discount"),
             "share_f": (F.col("l_linestatus") == "F").cast("double")}
    # Times as whole days and microseconds of the day: sums stay exact.
    day, micros = F.lit(tm.MICROS_PER_DAY).cast("bigint"), tm.epoch_micros("l_shipdate")
    parts = lambda m: (((m - F.pmod(m, day)) / day).cast("bigint"), F.pmod(m, day))
    lines = t.lineitem.where(F.col("l_orderkey").isNotNull()).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), *[e for k, c in means.items() for e in (F.sum(c).alias(f"s_{k}"), F.count(c).alias(f"c_{k}"))],
        F.sum(parts(micros)[0]).alias("days"), F.sum(parts(micros)[1]).alias("rest"), F.count("l_shipdate").alias("c_ship"))
    a = adm(t).select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderstatus", "o_orderdate").na.drop(
        subset=["o_orderkey", "o_totalprice", "c_acctbal", "o_orderstatus"])
    w = a.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    begin = parts(tm.epoch_micros("o_orderdate"))
    stay = (F.col("days") - F.col("c_ship") * begin[0]) + (F.col("rest") - F.col("c_ship") * begin[1]) / day
    g = w.groupBy("o_orderkey", "o_totalprice", "c_acctbal", "o_orderstatus").agg(
        F.sum("n").cast("double").alias("n_lines"), *[F.try_divide(F.sum(f"s_{k}"), F.sum(f"c_{k}")).alias(k) for k in means],
        F.try_divide(F.sum(stay), F.sum(F.when(stay.isNotNull(), F.col("c_ship")))).alias("los_mean"))
    return g.select(F.col("o_orderkey").alias("id"), *ADM_FEATURES, is_final().alias("label")).na.drop()


def kept_admissions(spark, d) -> DataFrame:
    """The training table worked out once: splits, fits and explanations read it many times."""
    from cohortkit.session import checkpoint_dir
    checkpoint_dir(spark)
    return admission_table(Tables(spark, d)).checkpoint(eager=True)


def embedding_table(t: Tables) -> DataFrame:
    e = t.embeddings
    return ml.array_features(e, "embedding", 64).drop("embedding")


_MODEL_CACHE: dict = {}


def _trained(spark, d, name="random_forest"):
    k = (spark.sparkContext.applicationId, d, name)
    if k not in _MODEL_CACHE:
        # The models of one folder share their rows.
        data = next((kept for (app, at, _), (_, kept) in _MODEL_CACHE.items() if (app, at) == k[:2]), None) or kept_admissions(spark, d)
        model, scored_, metrics = ml.train_model(data, ADM_FEATURES, name, "label", ["id"], seed=42,
                                                 **({"numTrees": 30, "maxDepth": 6} if name == "random_forest" else {}))
        _MODEL_CACHE[k] = (model, data)
    return _MODEL_CACHE[k]


def q_M01(spark, d):
    var, n95, proj = ml.pca_analysis(embedding_table(Tables(spark, d)), [f"x{i}" for i in range(64)])
    return r6(var.withColumn("n_components_95", F.lit(n95)))


def q_M02(spark, d):
    summary, assigned, clusters = ml.kmeans_analysis(embedding_table(Tables(spark, d)),
                                                     [f"x{i}" for i in range(64)], k=10, seed=42)
    return r6(clusters)


def q_M05(spark, d):
    data = kept_admissions(spark, d)
    bal = ml.smote(data, ADM_FEATURES, "label", ["id"], k=5, seed=42)
    return bal.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# Balanced: both labels have as many rows as the larger one had among complete admissions.
SQL_M05 = f"""
WITH a AS (SELECT o_orderkey, CAST(any_value(o_orderstatus) = 'F' AS INTEGER) AS label, any_value(o_totalprice) AS p, any_value(c_acctbal) AS b,
    avg(l_quantity) AS q, avg(l_extendedprice) AS x, avg(l_discount) AS d, avg(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f,
    avg(epoch_us(l_shipdate) - epoch_us(o_orderdate)) AS los
  FROM {WIDE_SQL} w GROUP BY o_orderkey),
n AS (SELECT label, count(*) AS n FROM a WHERE p IS NOT NULL AND b IS NOT NULL AND q IS NOT NULL AND x IS NOT NULL AND d IS NOT NULL
  AND f IS NOT NULL AND los IS NOT NULL AND label IS NOT NULL GROUP BY label)
SELECT label, (SELECT max(n) FROM n) AS n FROM n
"""
SQL_S11 = SQL_M05.replace("SELECT label, (SELECT max(n) FROM n) AS n FROM n", "SELECT CAST(sum(n) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS max_diff FROM n")


def q_M06(spark, d):
    data = ml.assemble(kept_admissions(spark, d), ADM_FEATURES)
    best, scores = ml.tune(data, "logistic", "features", "label", ["id"], n_trials=10, folds=3, seed=42, parallelism=3, sampler="sequential")
    return r6(spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "trial int, cv_roc_auc double"))


def q_M08(spark, d):
    data = kept_admissions(spark, d)
    bases, meta, oof = ml.stacking(data, ADM_FEATURES, label="label", key=["id"])
    return r6(oof)


def q_M09(spark, d):
    data = kept_admissions(spark, d)
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml import Pipeline
    train, test = ml.train_test(scale.standard_scale(data, ADM_FEATURES), "label", ["id"])
    pipe = Pipeline(stages=[VectorAssembler(inputCols=ADM_FEATURES, outputCol="features"),
                            ml.mlp(len(ADM_FEATURES), maxIter=50)])
    return r6(ev.evaluate(ml.score(pipe.fit(train), test)))


def q_M10(spark, d):
    data = kept_admissions(spark, d)
    metrics, best, fitted = ml.train_and_evaluate(data, ADM_FEATURES, "label", ["id"])
    return r6(metrics.drop("train_seconds").withColumn("best", F.col("model") == F.lit(best)))


def q_M11(spark, d):
    model, data = _trained(spark, d)
    return r6(ml.score(model, data).select("id", "label", "prediction", "score"))


def q_X01(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.builtin_importances(model, ADM_FEATURES, spark))


def q_X02(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.permutation_importance(model, data, ADM_FEATURES, "label", ["id"], seed=42))


def q_X03(spark, d):
    lr, data = _trained(spark, d, "logistic")
    attr = xp.linear_attributions(lr, data, ADM_FEATURES, ["id"])
    return r6(xp.explanation_stability(attr, ["id"], replicates=100, seed=42))


def q_X04(spark, d):
    lr, data = _trained(spark, d, "logistic")
    return r6(xp.attribution_summary(xp.linear_attributions(lr, data, ADM_FEATURES, ["id"])))


def q_X05(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.partial_dependence(model, data, ADM_FEATURES, resolution=20))


def q_X06(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.lime_weights(model, data, data.where(F.col("id") % 50 == 0), ADM_FEATURES, ["id"], samples=200, seed=42))


def q_X07(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.anchor_rules(model, data, data.where(F.col("id") % 50 == 0), ADM_FEATURES, ["id"], bins=4))


def q_X08(spark, d):
    model, data = _trained(spark, d)
    return r6(xp.counterfactuals(model, data, data.where(F.col("id") % 50 == 0), ADM_FEATURES, ["id"]))


def q_X09(spark, d):
    model, data = _trained(spark, d)
    a = xp.builtin_importances(model, ADM_FEATURES, spark)
    b = xp.permutation_importance(model, data, ADM_FEATURES, "label", ["id"], seed=42).select(
        "feature", F.col("importance_mean").alias("importance"))
    return r6(xp.compare_explanations(a, b))
