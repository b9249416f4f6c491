"""Tail probabilities for the few rows of a test report."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    num, den, frac = 1.0, 1.0 - (a + b) * x / (a + 1.0), 1.0
    den = 1.0 / (den if abs(den) > tiny else tiny)
    frac = den
    for m in range(1, 1000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            den = 1.0 + step * den
            den = 1.0 / (den if abs(den) > tiny else tiny)
            num = 1.0 + step / num
            num = num if abs(num) > tiny else tiny
            ratio = den * num
            frac *= ratio
        if abs(ratio - 1.0) < 1e-15:
            break
    return front * frac / a


def _t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(x) or n <= 0 else beta_tail(n / 2.0, 0.5, n / (n + x * x)) for x, n in zip(t, df)],
        dtype="float64",
    )


def _normal_two_sided(z: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else math.erfc(abs(x) / math.sqrt(2.0)) for x in z], dtype="float64")


def _sign_one(k: int, n: int) -> float | None:
    if n == 0:
        return None
    low = min(k, n - k)
    return 1.0 if 2 * low == n else min(1.0, 2.0 * beta_tail(n - low, low + 1.0, 0.5))


def _sign_two_sided(k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([_sign_one(a, b) for a, b in zip(k, n)], dtype="float64")


def t_two_sided(t: Column | str, df: Column | str) -> Column:
    """Two-sided p-value of Student's t."""
    return F.pandas_udf(_t_two_sided, "double")(t, df)


def normal_two_sided(z: Column | str) -> Column:
    return F.pandas_udf(_normal_two_sided, "double")(z)


def sign_two_sided(k: Column | str, n: Column | str) -> Column:
    """Exact two-sided p-value of k successes in n fair trials."""
    return F.pandas_udf(_sign_two_sided, "double")(k, n)
