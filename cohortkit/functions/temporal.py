"""Date and time column functions (F01–F07, F04/J05 holidays, D05).

All are plain column expressions: they run inside whole-stage codegen, need
no shuffle, and work unchanged on a streaming DataFrame.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_ts(col) -> Column:
    """Parse to ``timestamp_ntz``; unparseable text becomes NULL (``try_cast``)."""
    c = _c(col)
    return c.try_cast("timestamp_ntz")


def day_of_week(col) -> Column:
    """Monday = 0 … Sunday = 6 (pandas ``dt.dayofweek``)."""
    return F.weekday(_c(col))


def days_between(start, end, start_type=None, end_type=None) -> Column:
    """``end - start`` in fractional days (pandas ``total_seconds()/86400``).
    Wall-clock difference for ``timestamp_ntz``: no time-zone or DST shift."""
    return (epoch_micros(end, end_type) - epoch_micros(start, start_type)) / F.lit(MICROS_PER_DAY)


def epoch_micros(col, dtype=None) -> Column:
    """Microseconds since 1970-01-01 00:00.  ``timestamp`` (with zone): the
    instant.  ``timestamp_ntz``/``date`` (the default assumption): built
    from calendar fields, so the session time zone never enters (a cast to
    an instant would move wall times inside a DST gap)."""
    from pyspark.sql import types as T
    c = _c(col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        c = c.cast("timestamp_ntz")
    days = F.unix_date(F.to_date(c)).cast("long")
    secs = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
    frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return days * 86_400_000_000 + secs * 1_000_000 + frac


def instant_of(col) -> Column:
    """``timestamp_ntz`` → ``timestamp`` reading the wall time as UTC
    (needed for watermarks and windows; no session time zone involved)."""
    return F.timestamp_micros(epoch_micros(col))


def wall_time_of(col) -> Column:
    """Inverse of ``instant_of``: a ``timestamp`` → its UTC wall time as
    ``timestamp_ntz``, built from epoch microseconds."""
    us = F.unix_micros(_c(col))
    days = F.floor(us / 86_400_000_000).cast("int")
    rest = us - days.cast("long") * 86_400_000_000
    d = F.date_from_unix_date(days)
    secs = (rest / 1_000_000.0)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.floor(secs / 3600).cast("int"),
                                F.floor(secs / 60).cast("int") % 60, (secs % 60).cast("decimal(16,6)"))


def admission_parts(df: DataFrame, col: str, prefix: str = "admission") -> DataFrame:
    """hour, day of week, month and quarter of one time column."""
    c = F.col(col)
    return df.select("*",
                     F.hour(c).alias(f"{prefix}_hour"),
                     day_of_week(c).alias(f"{prefix}_day_of_week"),
                     F.month(c).alias(f"{prefix}_month"),
                     F.quarter(c).alias(f"{prefix}_quarter"))


# The names of the eleven per-column temporal features.
TEMPORAL_SUFFIXES = ["hour", "day", "month", "year", "dayofweek", "hour_sin", "hour_cos",
                     "month_sin", "month_cos", "is_holiday", "is_weekend"]


def temporal_columns(col: str) -> list[Column]:
    """F02–F05 for one time column: date parts, cyclical encoding, flags.

    Null timestamps give null parts and 0 flags.
    """
    c = F.col(col)
    h, m = F.hour(c), F.month(c)
    two_pi = 2 * math.pi
    return [
        h.alias(f"{col}_hour"),
        F.dayofmonth(c).alias(f"{col}_day"),
        m.alias(f"{col}_month"),
        F.year(c).alias(f"{col}_year"),
        day_of_week(c).alias(f"{col}_dayofweek"),
        F.sin(two_pi * h / 24).alias(f"{col}_hour_sin"),
        F.cos(two_pi * h / 24).alias(f"{col}_hour_cos"),
        F.sin(two_pi * m / 12).alias(f"{col}_month_sin"),
        F.cos(two_pi * m / 12).alias(f"{col}_month_cos"),
        F.coalesce(is_us_holiday(c), F.lit(False)).cast("int").alias(f"{col}_is_holiday"),
        F.coalesce(day_of_week(c).isin(5, 6), F.lit(False)).cast("int").alias(f"{col}_is_weekend"),
    ]


def temporal_features(df: DataFrame, time_cols: Sequence[str], admit: str | None = None,
                      disch: str | None = None, death: str | None = None) -> DataFrame:
    """F02–F07 in one projection: 11 columns per time column, ``los_days``
    and ``time_to_death`` when the bounds are given."""
    exprs = [e for c in time_cols for e in temporal_columns(c)]
    types = {f.name: f.dataType for f in df.schema.fields}
    if admit and disch:
        exprs.append(days_between(admit, disch, types.get(admit), types.get(disch)).alias("los_days"))
    if admit and death:
        exprs.append(days_between(admit, death, types.get(admit), types.get(death)).alias("time_to_death"))
    return df.select("*", *exprs)


# --- US federal holidays (F04 / J05) -------------------------------------

# month*100 + day of the fixed-date federal holidays
# (New Year's Day, Independence Day, Veterans Day, Christmas Day), and of
# Juneteenth, which counts from 2021.
FIXED_HOLIDAYS = [101, 704, 1111, 1225]
JUNETEENTH = 619
# month*10 + n for "n-th Monday of the month" holidays
# (Washington's Birthday: 3rd Monday of February, Labor Day: 1st Monday of
# September, Columbus Day: 2nd Monday of October); Martin Luther King Jr.
# Day (3rd Monday of January) counts from 1986.
NTH_MONDAY_HOLIDAYS = [23, 91, 102]
MLK_DAY = 13


def _fixed_holiday(d: Column) -> Column:
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.isin(FIXED_HOLIDAYS) | ((md == JUNETEENTH) & (F.year(d) >= 2021))


def _floating_holiday(d: Column) -> Column:
    m, dd, wd = F.month(d), F.dayofmonth(d), F.weekday(d)
    nth = m * 10 + F.floor((dd - 1) / 7).cast("int") + 1
    monday = (nth.isin(NTH_MONDAY_HOLIDAYS) | ((nth == MLK_DAY) & (F.year(d) >= 1986))
              | ((m == 5) & (dd >= 25)))                       # Memorial Day: last Monday of May
    return ((wd == 0) & monday) | ((wd == 3) & (nth == 114))  # Thanksgiving: 4th Thursday of November


def is_us_holiday(col) -> Column:
    """True when the calendar date of ``col`` is a US federal holiday or
    its observed day (a fixed date on Saturday is observed the Friday
    before, on Sunday the Monday after).  A pure expression: no lookup
    table, no join, no Python."""
    d = F.to_date(_c(col))
    wd = F.weekday(d)
    observed = (((wd == 4) & _fixed_holiday(F.date_add(d, 1)))
                | ((wd == 0) & _fixed_holiday(F.date_sub(d, 1))))
    return F.when(d.isNull(), None).otherwise(_fixed_holiday(d) | _floating_holiday(d) | observed)


def holiday_dim(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """J05 as a table: ``(holiday_date date)`` for the given years.

    At most 366 rows a year, so it is safe to broadcast; most callers should
    use ``is_us_holiday`` and skip the join altogether.
    """
    days = spark.sql(
        f"SELECT explode(sequence(make_date({int(first_year) - 1}, 12, 31), "
        f"make_date({int(last_year)}, 12, 31))) AS holiday_date")
    return days.where(is_us_holiday("holiday_date")).where(
        F.year("holiday_date").between(first_year, last_year))


def flag_holidays_by_join(df: DataFrame, col: str, holidays: DataFrame,
                          name: str = "is_holiday") -> DataFrame:
    """J05 literal form: broadcast left join of a holiday table on the date."""
    h = holidays.select(F.col("holiday_date").alias("_ck_hd")).distinct()
    j = df.join(F.broadcast(h), F.to_date(F.col(col)) == F.col("_ck_hd"), "left")
    return j.select(*[F.col(c) for c in df.columns],
                    F.col("_ck_hd").isNotNull().cast("int").alias(name))


def validate_temporal(df: DataFrame, admit: str, disch: str | None = None, death: str | None = None,
                      as_of=None) -> DataFrame:
    """Parse time columns (bad text → NULL), NULL out times after
    ``as_of`` (default: now), NULL a discharge that precedes admission."""
    cutoff = F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    parsed = {}
    for c in [x for x in (admit, disch, death) if x]:
        t = to_ts(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c).cast("timestamp_ntz")
        parsed[c] = F.when(t > cutoff, None).otherwise(t)
    if disch:
        parsed[disch] = F.when(parsed[disch] < parsed[admit], None).otherwise(parsed[disch])
    return df.select(*[parsed[c].alias(c) if c in parsed else F.col(c) for c in df.columns])


def time_series(df: DataFrame, ts: str, unit: str = "day", labels: Sequence[str] = (),
                value: str | None = None) -> DataFrame:
    """Counts (and mean / exact median of ``value``) per time bucket
    and label.  Medians come from the distributed selection helper."""
    from cohortkit.functions.ordered import quantiles

    b = df.select(F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("bucket"), *labels,
                  *([F.col(value)] if value else []))
    keys = ["bucket", *labels]
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg(value).alias(f"{value}_mean"))
    out = b.groupBy(*keys).agg(*aggs)
    if value:
        med = quantiles(b, [value], {f"{value}_median": 0.5}, by=keys).drop("column")
        out = out.join(med, keys, "left")
    return out
