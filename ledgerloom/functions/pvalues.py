"""Tail probabilities as vectorised functions.

They run on rows that are already aggregated (one per experiment and test), so the Python step
sees a handful of values whatever the size of the data.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship these functions with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _log_beta_half(a: float) -> float:
    """log B(a, 1/2). The series avoids subtracting two huge log-gammas when ``a`` is large."""
    if a < 1e4:
        step = math.lgamma(a + 0.5) - math.lgamma(a)
    else:
        step = 0.5 * math.log(a) - 1.0 / (8.0 * a) + 1.0 / (192.0 * a**3)
    return 0.5 * math.log(math.pi) - step


# Points and weights of double-exponential quadrature over [0, inf).
_AT = np.arange(-6.0, 6.0, 1 / 64)
_POINTS = np.exp(np.pi / 2 * np.sinh(_AT))
_WEIGHTS = np.pi / 2 * np.cosh(_AT) * _POINTS / 64


def _normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), na_action="ignore").astype(float)


def _student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Integral of the density over both tails; the logarithm keeps its digits for any ``df``."""

    def tail(stat: float, dof: float) -> float | None:
        if pd.isna(stat) or pd.isna(dof):
            return None
        x = abs(stat) + _POINTS
        # x² / dof without overflow of x².
        log_density = -0.5 * (dof + 1) * np.log1p(x / dof * x)
        constant = -_log_beta_half(dof / 2.0) - 0.5 * math.log(dof)
        return min(1.0, 2 * float(_WEIGHTS @ np.exp(log_density + constant)))

    return pd.Series([tail(a, b) for a, b in zip(t, df)], dtype="float64")


def _upper_gamma_share(a: float, x: float) -> float:
    """Q(a, x): the share of the gamma density with shape ``a`` that lies above ``x``."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # the share below, by its power series
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - scale * total)
    # Continued fraction, from the front.
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    value = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = step * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + step / c
        c = c if abs(c) > tiny else tiny
        value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return min(1.0, scale * value)


def _chi_square_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    def tail(stat: float, degrees: float) -> float | None:
        if pd.isna(stat) or pd.isna(degrees) or degrees <= 0:
            return None
        return _upper_gamma_share(degrees / 2, stat / 2)

    return pd.Series([tail(a, b) for a, b in zip(x, df)], dtype="float64")


# By the automatic method, the exact rank-sum distribution applies up to this smaller sample size,
# if no values are tied.
EXACT_SAMPLE = 8
RANK_METHODS = ("auto", "exact", "normal")


def _rank_sum_exact(u: float, n1: int, n2: int) -> float:
    """2·P(U >= larger of the two U), capped at one, for tie-free samples.

    Counts the arrangements with each U by the Gaussian binomial coefficient, in whole numbers.
    """
    small, large = sorted((int(n1), int(n2)))
    upto = int(n1 * n2 - max(u, n1 * n2 - u))
    every = math.comb(small + large, small)
    ways = np.zeros(upto + 1, dtype=np.int64 if every < 1 << 62 else object)
    ways[0] = 1
    for i in range(1, small + 1):
        if large + i <= upto:
            ways[large + i:] -= ways[:upto + 1 - large - i].copy()
        rows = -(-len(ways) // i)
        padded = np.concatenate([ways, np.zeros(rows * i - len(ways), dtype=ways.dtype)])
        ways = np.cumsum(padded.reshape(rows, i), axis=0).ravel()[:upto + 1]
    return min(1.0, 2 * int(ways.sum()) / every)


def rank_sum_two_sided(
    u: Column, n1: Column, n2: Column, ties: Column, z: Column, method: str = "auto"
) -> Column:
    """Two-sided p of the Mann-Whitney U. ``exact`` and ``normal`` (by ``z``) apply to all rows;
    ``auto`` is exact if one sample has at most eight values and none are tied."""
    if method not in RANK_METHODS:
        raise ValueError(f"unknown method: {method}")

    def tail(stat: float, a: int, b: int, tied: float, normal: float) -> float | None:
        if not a or not b or pd.isna(stat):
            return None
        if method == "exact" or method == "auto" and tied == 0 and min(a, b) <= EXACT_SAMPLE:
            return _rank_sum_exact(stat, a, b)
        if pd.isna(normal):
            return None
        # The continuity correction can take the statistic below zero; the tail is then over 1/2.
        return 1.0 if normal <= 0 else math.erfc(normal / math.sqrt(2.0))

    def tails(u: pd.Series, n1: pd.Series, n2: pd.Series, ties: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series([tail(*row) for row in zip(u, n1, n2, ties, z)], dtype="float64")

    return F.pandas_udf(tails, "double")(u, n1, n2, ties, z)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|). Uses erfc, so far tails keep their digits."""
    return F.pandas_udf(_normal_two_sided, "double")(z)


def student_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for ``df`` (possibly fractional) degrees of freedom."""
    return F.pandas_udf(_student_two_sided, "double")(t, df)


def chi_square_tail(x: Column, df: Column) -> Column:
    """P(X >= x) for ``df`` degrees of freedom; null for none."""
    return F.pandas_udf(_chi_square_tail, "double")(x, df)
