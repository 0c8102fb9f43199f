"""Tail probabilities of the t and chi-square distributions.

SciPy is not assumed.  Regularized incomplete beta and gamma functions are
evaluated by continued fractions (Lentz) and series; they are applied as
Arrow-batched pandas UDFs to result tables of one row per column, never to
data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def gammaincc(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = d if abs(d) > _TINY else _TINY
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        d = 1.0 / d
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def t_two_sided_p(t: float, dof: float) -> float:
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def chi2_sf(x: float, dof: float) -> float:
    if x is None or dof is None or math.isnan(x) or dof <= 0:
        return float("nan")
    return gammaincc(dof / 2.0, x / 2.0)


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, dof)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_pvalue_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(x, dof)],
                     dtype="float64")
