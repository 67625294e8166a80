"""Distribution tails as Spark Column expressions.

They run on the one-row-per-feature results of the drift aggregates, so
they cost nothing at scale and need no Python worker.  Every series is a
fixed-length fold (``aggregate(sequence(...))``) evaluated in log space.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kolmogorov series length and the small-lambda cut-off (Stephens 1970 form).
KS_TERMS = 100
KS_SMALL_LAMBDA = 0.2
# erf series length; erfc(z) is taken as 0 beyond z^2 > ERFC_ZERO_BEYOND.
ERF_TERMS = 200
ERFC_ZERO_BEYOND = 50.0


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def ks_lambda(d, n, m) -> Column:
    d, n, m = _c(d).cast("double"), _c(n).cast("double"), _c(m).cast("double")
    en = F.sqrt(n * m / (n + m))
    return (en + F.lit(0.12) + F.lit(0.11) / en) * d


def ks_pvalue(d, n, m) -> Column:
    """Two-sided asymptotic p of the two-sample KS statistic ``d``."""
    n, m = _c(n), _c(m)
    lam = ks_lambda(d, n, m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.pow(F.lit(-1.0), (k - 1).cast("double")) * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return (
        F.when(n.isNull() | m.isNull() | (n <= 0) | (m <= 0) | _c(d).isNull(), F.lit(None).cast("double"))
        .when(lam < KS_SMALL_LAMBDA, F.lit(1.0))
        .otherwise(p)
    )


def ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) for samples of n and m without ties.

    Lattice paths from (0, 0) to (n, m) that stay inside |i/n - j/m| < d, folded
    row by row: a row is the running sum of the former one inside the band,
    scaled by i / (i + m) so that the last entry is the share of all paths."""
    if m > n:
        n, m = m, n
    h = int(round(d * n * m))  # the statistic on the grid 1 / (n m)
    j = np.arange(m + 1) * n
    inside = np.where(j < h, 1.0, 0.0)
    for i in range(1, n + 1):
        # paths reach a row's cell from below or along the row; the band's cells are contiguous
        inside = np.cumsum(np.where(np.abs(i * m - j) < h, inside, 0.0)) * (i / (i + m))
        inside[np.abs(i * m - j) >= h] = 0.0
    return float(min(1.0, max(0.0, 1.0 - inside[m])))


def ks_exact_pvalue(d, n, m, up_to: int) -> Column:
    """Exact p where the larger sample has at most ``up_to`` rows, else the asymptotic one.

    The fold takes n m steps on one row per feature, in Python; it sees only the rows it is meant for."""
    @F.pandas_udf("double")
    def exact(ds: pd.Series, ns: pd.Series, ms: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) else ks_exact(a, int(b), int(c)) for a, b, c in zip(ds, ns, ms)], dtype="float64")

    n, m = _c(n), _c(m)
    small = (F.greatest(n, m) <= up_to) & (n > 0) & (m > 0)
    return F.when(small, exact(F.when(small, _c(d)), n, m)).otherwise(ks_pvalue(d, n, m))


def erfc_pos(z) -> Column:
    """erfc(z) for z >= 0, absolute error ~1e-15 (series of erf, log space)."""
    z = _c(z).cast("double")
    z2 = z * z
    lnz = F.log(z)
    ln2z2 = F.log(F.lit(2.0) * z2)

    def step(acc, n):
        lt = F.when(n == 0, lnz - z2).otherwise(acc["lt"] + ln2z2 - F.log((F.lit(2) * n + 1).cast("double")))
        return F.struct(lt.alias("lt"), (acc["s"] + F.exp(lt)).alias("s"))

    init = F.struct(F.lit(0.0).alias("lt"), F.lit(0.0).alias("s"))
    erf = F.lit(2.0 / math.sqrt(math.pi)) * F.aggregate(F.sequence(F.lit(0), F.lit(ERF_TERMS)), init, step)["s"]
    return F.when(z <= 0, F.lit(1.0)).when(z2 > ERFC_ZERO_BEYOND, F.lit(0.0)).otherwise(F.greatest(F.lit(1.0) - erf, F.lit(0.0)))


def _log_factorial(x) -> Column:
    """ln Gamma(x + 1) for 0 <= x < 1000: Stirling's series ten steps up."""
    y = x + F.lit(10.0)
    up = F.lit(0.0)
    for k in range(1, 11):
        up = up + F.log(x + F.lit(float(k)))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return y * F.log(y) - y + F.lit(0.5) * F.log(F.lit(2 * math.pi) * y) + series - up


def _log_poisson(x, h) -> Column:
    """ln of e^-h h^x / Gamma(x + 1); for large x by its relative gap to h, so that nothing cancels."""
    r = (h - x) / x
    far = x * (F.log1p(r) - r) - F.lit(0.5) * F.log(F.lit(2 * math.pi) * x) - 1 / (12 * x) + 1 / (360 * x * x * x)
    return F.when(x < 1000, x * F.log(h) - h - _log_factorial(x)).otherwise(far)


def _poisson_band(h, low, top, shift: float) -> Column:
    """Sum of e^-h h^(i + shift) / Gamma(i + shift + 1) over i in low..top.

    Terms rise to about h and fall again; beyond nine standard deviations they
    are below the last digit, so only that band is folded, downwards from its
    top: O(sqrt(h)) terms for any number of degrees of freedom."""
    width = F.ceil(F.lit(9.0) * F.sqrt(h) + F.lit(50.0)).cast("long")
    middle = F.floor(h).cast("long")
    last = F.least(top, middle + width)
    first = F.greatest(low, F.least(last, middle) - width)
    x = last.cast("double") + F.lit(shift)
    init = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))

    def step(acc, k):
        return F.struct((acc["t"] * (x - k) / h).alias("t"), (acc["s"] + acc["t"]).alias("s"))

    total = F.aggregate(F.sequence(F.lit(0), F.greatest(last - first, F.lit(0)).cast("int")), init, step)["s"]
    return F.when(last < first, F.lit(0.0)).otherwise(F.exp(_log_poisson(x, h)) * total)


def chi2_sf(x, dof) -> Column:
    """Survival function of chi-square with integer ``dof`` (any size, one closed form)."""
    x = _c(x).cast("double")
    dof = _c(dof).cast("long")
    h = x / F.lit(2.0)
    half = F.floor(dof / 2).cast("long")
    even = _poisson_band(h, F.lit(0).cast("long"), half - 1, 0.0)
    odd = erfc_pos(F.sqrt(h)) + _poisson_band(h, F.lit(1).cast("long"), half, -0.5)
    return (
        F.when(x.isNull() | dof.isNull(), F.lit(None).cast("double"))
        .when(dof <= 0, F.lit(1.0))
        .when(x <= 0, F.lit(1.0))
        .otherwise(F.least(F.greatest(F.when(dof % 2 == 0, even).otherwise(odd), F.lit(0.0)), F.lit(1.0)))
    )


def adjusted_skewness(g1, n) -> Column:
    """Bias-adjusted sample skewness G1 from Spark's population g1."""
    n = _c(n).cast("double")
    return F.when(n > 2, _c(g1) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(g2, n) -> Column:
    """Bias-adjusted excess kurtosis G2 from Spark's population excess g2."""
    n = _c(n).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * _c(g2) + 6))
