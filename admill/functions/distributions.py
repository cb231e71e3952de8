"""Tail probabilities of t and F statistics, as columns over a few summary rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction, on the side where that converges fast."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, top, bottom, value = 1e-300, 1.0, 0.0, 1.0
    for i in range(1000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        bottom = 1 / (d if abs(d := 1 + term * bottom) > tiny else tiny)
        top = c if abs(c := 1 + term / top) > tiny else tiny
        value *= top * bottom
        if i and abs(1 - top * bottom) < 1e-14:
            break
    return front * (value - 1)


def t_tail(t: float, df: float) -> float:
    """Two-sided probability of a t statistic."""
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def f_tail(f: float, top: float, bottom: float) -> float:
    """Upper probability of an F statistic."""
    return incomplete_beta(bottom / 2, top / 2, bottom / (bottom + top * f))


def _over(fn, *values: pd.Series) -> pd.Series:
    return pd.Series([None if any(pd.isna(v) for v in row) else fn(*map(float, row)) for row in zip(*values)], dtype="float64")


def t_probability(t: Column, df: Column) -> Column:
    return F.pandas_udf(lambda a, b: _over(t_tail, a, b), "double")(t.cast("double"), df.cast("double"))


def f_probability(f: Column, top: Column, bottom: Column) -> Column:
    return F.pandas_udf(lambda a, b, c: _over(f_tail, a, b, c), "double")(f.cast("double"), top.cast("double"), bottom.cast("double"))
