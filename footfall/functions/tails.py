"""Two-sided p-values, as vectorised functions over result rows only."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _stirling(x: float) -> float:
    """What the logarithm of gamma exceeds ``(x - 1/2) log x - x + log(2 pi) / 2`` by."""
    square = x * x
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / square) / square) / square) / x


def log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function; differences of large logarithms are taken in closed form."""
    small, large = min(a, b), max(a, b)
    if large < 100:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    gap = _stirling(large) - _stirling(large + small)
    # log gamma(large) - log gamma(large + small)
    ratio = -(large - 0.5) * math.log1p(small / large) - small * math.log(large + small) + small
    return math.lgamma(small) + ratio + gap if small < 100 else _large_beta(small, large)


def _large_beta(a: float, b: float) -> float:
    total = a + b
    return (
        0.5 * math.log(2 * math.pi) + (a - 0.5) * math.log(a / total) + (b - 0.5) * math.log(b / total)
        - 0.5 * math.log(total) + _stirling(a) + _stirling(b) - _stirling(total)
    )


def beta_tail(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b) by its continued fraction.

    ``rest`` is 1 - x, for callers who know it without cancellation.
    """
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0:
        return 0.0
    if rest <= 0.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(b, a, rest, x)
    log_x = math.log(x) if x < 0.5 else math.log1p(-rest)
    log_rest = math.log1p(-x) if x < 0.5 else math.log(rest)
    front = math.exp(a * log_x + b * log_rest - log_beta(a, b))
    tiny = 1e-300
    fraction, c, d = 1.0, 1.0, 0.0
    for step in range(400):
        m = step // 2
        if step == 0:
            term = 1.0
        elif step % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + term * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + term / c
        c = c if abs(c) > tiny else tiny
        fraction *= c * d
        if abs(1.0 - c * d) < 1e-14:
            break
    return front * (fraction - 1.0) / a


def t_p(t: float, df: float) -> float:
    if t is None or df is None or not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return math.nan
    if df > 1e6:  # the continued fraction cancels; the expansion's next term is of order t**7 / df**2
        density = math.exp(-t * t / 2.0) / math.sqrt(2.0 * math.pi)
        return normal_p(t) + density * (abs(t) ** 3 + abs(t)) / (2.0 * df)
    return beta_tail(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def normal_p(z: float) -> float:
    if z is None or not math.isfinite(z):
        return math.nan
    return math.erfc(abs(z) / math.sqrt(2.0))


def _nullable(values) -> pd.Series:
    array = np.asarray(values, dtype="float64")
    return pd.Series(array).astype(object).where(~np.isnan(array), None)


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable([t_p(a, b) for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return _nullable([normal_p(v) for v in z])
