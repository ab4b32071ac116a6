"""Normal-distribution functions as SQL expression strings.

Neither Spark SQL nor DuckDB has ``erf``. The upper tail of the standard
normal is therefore written once as a plain SQL expression (only ``abs``,
``exp``, ``CASE``, arithmetic) that both engines evaluate identically. The
same string feeds ``F.expr`` in the library and the DuckDB oracle queries.

Method: Hart's double-precision rational approximation in the form given by
G. West, "Better approximations to cumulative normal functions" (Wilmott,
2005) for |x| < 7.07, and the Laplace continued fraction of the Mills ratio
beyond; relative error about 1e-14 everywhere.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart (1968) / West (2005) coefficients for the tail
# T(a) = P(Z <= -a), a = |x| < 7.07106781186547.
_NUM = [
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
]
_DEN = [
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
]
_SWITCH = 7.07106781186547
_FAR = 37.0
_SQRT_2PI = math.sqrt(2 * math.pi)
# Terms of the continued fraction a + 1/(a + 2/(a + 3/(...))) used beyond
# the rational range; 12 terms give ~1e-14 relative error there.
_CF_TERMS = 12


def _horner(coeffs: list[float], a: str) -> str:
    expr = repr(coeffs[0])
    for c in coeffs[1:]:
        expr = f"(({expr}) * {a} + {repr(c)})"
    return expr


def lower_tail_abs_sql(a: str) -> str:
    """P(Z <= -a) for a non-negative SQL expression ``a``."""
    near = f"(exp(-({a}) * ({a}) / 2.0) * {_horner(_NUM, a)} / {_horner(_DEN, a)})"
    cf = f"({a})"
    for k in range(_CF_TERMS, 0, -1):
        cf = f"({a} + {k}.0 / {cf})"
    far = f"(exp(-({a}) * ({a}) / 2.0) / {cf} / {_SQRT_2PI!r})"
    return f"(CASE WHEN {a} >= {_FAR} THEN 0.0 WHEN {a} >= {_SWITCH} THEN {far} ELSE {near} END)"


def norm_sf_sql(x: str) -> str:
    """Upper tail P(Z > x) as SQL; NULL in, NULL out."""
    a = f"abs(CAST({x} AS DOUBLE))"
    t = lower_tail_abs_sql(a)
    return f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) >= 0 THEN {t} ELSE 1.0 - {t} END)"


def norm_cdf_sql(x: str) -> str:
    """P(Z <= x) as SQL."""
    return norm_sf_sql(f"(-({x}))")


def two_sided_p_sql(z: str) -> str:
    """2 * P(Z > |z|), clipped to 1."""
    a = f"abs(CAST({z} AS DOUBLE))"
    return f"(CASE WHEN ({z}) IS NULL THEN NULL ELSE least(1.0, 2.0 * {lower_tail_abs_sql(a)}) END)"


def norm_pdf_sql(x: str) -> str:
    return f"(exp(-({x}) * ({x}) / 2.0) / {math.sqrt(2 * math.pi)!r})"


def norm_sf(col: Column | str) -> Column:
    name = col if isinstance(col, str) else None
    if name is None:
        raise TypeError("pass a column name or SQL expression string")
    return F.expr(norm_sf_sql(name))


def norm_ppf(p: float) -> float:
    """Inverse normal CDF for driver-side scalar parameters (alpha, power)."""
    return NormalDist().inv_cdf(p)
