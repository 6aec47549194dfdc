"""p-values for a handful of test statistics (one row per tested column).

Spark has no special functions; these run in a vectorised UDF over result
tables that are as long as the list of tested columns.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_tail(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * total / a


def gamma_tail(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    total = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2
        d = step * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + step / c
        c = c if abs(c) > tiny else tiny
        total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * total


def student_two_sided(t: float, dof: float) -> float:
    return beta_tail(dof / 2, 0.5, dof / (dof + t * t))


def chi_square_tail(statistic: float, dof: float) -> float:
    return gamma_tail(dof / 2, statistic / 2)


def ks_limit(d: float, n: int, m: int) -> float:
    """Kolmogorov's limit law for the two-sample statistic."""
    z = math.sqrt(n * m / (n + m)) * d
    if z < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) under equal distributions, by counting the lattice paths that stay inside.

    Each row of the lattice is rescaled so path counts never overflow.
    """
    if n < m:
        n, m = m, n
    lattice = n // math.gcd(n, m) * m
    reach = round(d * lattice)
    if reach <= 0:
        return 1.0
    up, across = lattice // n, lattice // m
    columns = np.arange(n + 1, dtype=np.int64) * up
    inside = columns < reach
    paths = inside.astype(float)
    log_scale = 0.0
    for j in range(1, m + 1):
        inside = np.abs(columns - j * across) < reach
        paths = np.cumsum(np.where(inside, paths, 0.0)) * inside
        top = paths.max()
        if top == 0:
            return 1.0
        paths /= top
        log_scale += math.log(top)
    if paths[-1] <= 0:
        return 1.0
    log_all = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    stay = math.exp(min(0.0, math.log(paths[-1]) + log_scale - log_all))
    return min(1.0, max(0.0, 1.0 - stay))


#: The laws of the two-sample statistic. The exact one takes steps in the number of rows.
KS_LAWS = {"limit": ks_limit, "exact": ks_exact}


@pandas_udf(DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [student_two_sided(a, b) if pd.notna(a) else None for a, b in zip(t, dof)], dtype="float64"
    )


@pandas_udf(DoubleType())
def chi_square_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [chi_square_tail(a, b) if pd.notna(a) and b > 0 else None for a, b in zip(statistic, dof)],
        dtype="float64",
    )


def ks_p_value(d: Column | str, n: Column | str, m: Column | str, law: str = "limit") -> Column:
    """The chance of a statistic of at least ``d``, by one law at every size; for result rows only."""
    chance = KS_LAWS[law]

    @pandas_udf(DoubleType())
    def found(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series(
            [
                chance(a, int(b), int(c)) if pd.notna(a) and b and c else None
                for a, b, c in zip(d, n, m)
            ],
            dtype="float64",
        )

    return found(d, n, m)
