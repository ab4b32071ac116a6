"""Student-t and chi-square tail probabilities.

These run only on small result tables (one row per feature or segment), as
Arrow-batched pandas UDFs. The maths is the textbook continued-fraction /
series evaluation of the regularised incomplete beta and gamma functions
(Press et al., Numerical Recipes, ch. 6), written here with NumPy scalars.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_FPMIN = 1e-300
_MAXIT = 100_000


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = _FPMIN if abs(d) < _FPMIN else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAXIT + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _FPMIN if abs(d) < _FPMIN else d
        c = 1.0 + aa / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _FPMIN if abs(d) < _FPMIN else d
        c = 1.0 + aa / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, delta = a, 1.0 / a, 1.0 / a
        for _ in range(_MAXIT):
            ap += 1.0
            delta *= x / ap
            s += delta
            if abs(delta) < abs(s) * _EPS:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b = x + 1.0 - a
    c = 1.0 / _FPMIN
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT + 1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _FPMIN if abs(d) < _FPMIN else d
        c = b + an / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T_dof| > |t|)."""
    if t is None or dof is None or not np.isfinite(t) or not np.isfinite(dof) or dof <= 0:
        return float("nan")
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def chi2_sf(x: float, dof: float) -> float:
    """P(X^2_dof > x)."""
    if x is None or dof is None or not np.isfinite(x) or dof <= 0:
        return float("nan")
    return gammaincc(dof / 2.0, x / 2.0)


def _nan_to_none(values: list[float]) -> pd.Series:
    s = pd.Series(values, dtype="float64")
    return s.where(np.isfinite(s), None)


@F.pandas_udf(T.DoubleType())
def t_two_sided_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _nan_to_none([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else float("nan") for a, b in zip(t, dof)])


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _nan_to_none([chi2_sf(a, b) if pd.notna(a) and pd.notna(b) else float("nan") for a, b in zip(x, dof)])
