"""Joins (J01–J04).

Strategy is left to Catalyst + AQE: a side that turns out small at runtime
becomes a broadcast hash join, a skewed key is split by AQE's skew-join
rule.  ``broadcast_if_small`` adds an explicit, size-checked hint for callers
that know one side is a dimension table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only after checking the side holds ≤ ``max_rows`` rows.

    The check stops reading after ``max_rows + 1`` rows; beyond the bound the
    frame is returned unchanged and the join shuffles (sort-merge).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def merge(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None,
          how: str = "left", suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = False,
          broadcast_rows: int | None = None, skewed_right: bool = False) -> DataFrame:
    """Equi-join that keeps one copy of each key and suffixes other
    overlapping column names, as ``pandas.merge`` does.

    ``null_safe`` matches NULL keys with each other (pandas behaviour);
    the default is SQL semantics.

    ``skewed_right`` (left joins whose right side may hold a hot key, e.g.
    admissions ⟕ lab events): AQE can split skewed partitions only on the
    outer side of a left join, so the join is run as an inner join (both
    sides splittable) plus the unmatched left rows from an anti join
    against the right side's distinct keys.
    """
    left_on = list(left_on)
    right_on = list(right_on or left_on)
    if broadcast_rows:
        right = broadcast_if_small(right, broadcast_rows)
    lk = set(left_on)
    rk = set(right_on)
    overlap = (set(left.columns) - lk) & (set(right.columns) - rk)
    l2 = left.select(*[F.col(c).alias(c + suffixes[0] if c in overlap else c) for c in left.columns]).alias("_l")
    r2 = right.select(*[F.col(c).alias(c + suffixes[1] if c in overlap else c)
                        for c in right.columns]).alias("_r")
    conds = [(F.col(f"_l.{a}").eqNullSafe(F.col(f"_r.{b}")) if null_safe else F.col(f"_l.{a}") == F.col(f"_r.{b}"))
             for a, b in zip(left_on, right_on)]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    same = [a for a, b in zip(left_on, right_on) if a == b]
    if skewed_right and how in ("left", "left_outer") and not null_safe:
        inner = _project(l2.join(r2, cond, "inner"), l2, r2, same, "inner")
        rkeys = r2.select(*[F.col(b).alias(f"_ck_rk{i}") for i, b in enumerate(right_on)]).distinct()
        acond = None
        for i, a in enumerate(left_on):
            c = F.col(f"_l.{a}") == F.col(f"_ck_rk{i}")
            acond = c if acond is None else acond & c
        unmatched = l2.join(rkeys, acond, "left_anti")
        rtypes = dict(r2.dtypes)
        pad = [F.lit(None).cast(rtypes[c]).alias(c) for c in r2.columns if c not in same]
        return inner.unionByName(unmatched.select(*[F.col(f"_l.{c}") for c in l2.columns], *pad))
    j = l2.join(r2, cond, how)
    return _project(j, l2, r2, same, how)


def _project(j, l2, r2, same, how):
    out = []
    for c in l2.columns:
        if c in same and how in ("right", "right_outer"):
            out.append(F.col(f"_r.{c}").alias(c))
        elif c in same and how in ("full", "outer", "full_outer"):
            out.append(F.coalesce(F.col(f"_l.{c}"), F.col(f"_r.{c}")).alias(c))
        else:
            out.append(F.col(f"_l.{c}"))
    if how not in ("left_semi", "semi", "left_anti", "anti"):
        out += [F.col(f"_r.{c}") for c in r2.columns if c not in same]
    return j.select(*out)


def join_back(rows: DataFrame, stats: DataFrame, key: Sequence[str]) -> DataFrame:
    """Attach per-key statistics to every row (left join)."""
    return rows.join(stats, list(key), "left")


def concat_columns(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Column-wise concatenation by key, never by position."""
    return left.join(right, list(key), "left")
