"""Small driver-side numerics on scalars and tiny matrices (never on data rows).

* studentized range distribution (Tukey HSD critical values), by Gauss-Legendre quadrature;
* F and t tail probabilities via the regularised incomplete beta function;
* orthonormal polynomial contrasts for ordered factors;
* the Anderson-Darling p-value formula for a normality statistic.

scipy is not available; everything is numpy plus the standard library.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np


_erfc = np.vectorize(math.erfc, otypes=[float])


def norm_cdf(x):
    """Standard normal CDF in double precision (for driver-side arrays)."""
    x = np.asarray(x, dtype=float)
    return 0.5 * _erfc(-x / math.sqrt(2.0))


def norm_logcdf(x) -> np.ndarray:
    """ln of the standard normal CDF, vectorised. The lower half is computed in log space from
    a Chebyshev fit of erfc (relative error < 1.2e-7), so no tail is cut off."""
    x = np.asarray(x, dtype=float)
    z = np.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.5 * z)
    poly = (-z * z - 1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (
        -0.18628806 + t * (0.27886807 + t * (-1.13520398 + t * (1.48851587 + t * (
            -0.82215223 + t * 0.17087277)))))))))
    tail = math.log(0.5) + np.log(t) + poly               # ln CDF(-|x|)
    return np.where(x < 0, tail, np.log1p(-np.exp(tail)))


def norm_ppf(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _gl(n: int, a: float, b: float) -> tuple[np.ndarray, np.ndarray]:
    x, w = np.polynomial.legendre.leggauss(n)
    return 0.5 * (b - a) * x + 0.5 * (b + a), 0.5 * (b - a) * w


_Z, _WZ = _gl(200, -8.5, 8.5)
_PHI = np.exp(-0.5 * _Z * _Z) / math.sqrt(2 * math.pi)
_CDF_Z = norm_cdf(_Z)


def _prange_inf(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals <= w), for an array of w."""
    w = np.atleast_1d(np.asarray(w, dtype=float))
    inner = np.clip(_CDF_Z[None, :] - norm_cdf(_Z[None, :] - w[:, None]), 0.0, 1.0) ** (k - 1)
    out = k * (inner * (_WZ * _PHI)[None, :]).sum(axis=1)
    return np.where(w > 0, out, 0.0)


def ptukey(q: float, k: int, df: float) -> float:
    """CDF of the studentized range with ``k`` means and ``df`` error degrees of freedom."""
    if q <= 0:
        return 0.0
    # s = chi_df / sqrt(df); integrate the density of s against P_inf(q s). The density is taken
    # relative to its value at 1 and normalised by its own integral, so large df do not cancel.
    half = 9.0 / math.sqrt(2 * df)
    lo, hi = max(1e-6, 1 - half), 1 + half * (1.5 if df < 10 else 1.0)
    if df < 10:
        hi = max(hi, 6.0)
    e, w = _gl(160, lo - 1.0, hi - 1.0)
    dens = w * np.exp(df * (np.log1p(e) - e - 0.5 * e * e) - np.log1p(e))
    return float(np.sum(dens * _prange_inf(q * (1.0 + e), k)) / np.sum(dens))


@lru_cache(maxsize=1024)
def qtukey(p: float, k: int, df: float) -> float:
    """Quantile of the studentized range: a bracket, then false position that halves the weight of
    an end that stays (about ten evaluations of ``ptukey``)."""
    a, b, fa = 0.0, 8.0, -p
    while (fb := ptukey(b, k, df) - p) < 0:               # the bracket grows until it holds the quantile
        a, b, fa = b, 2.0 * b, fb
    side = 0
    for _ in range(200):
        if fb == 0 or b - a < 1e-12 * b:
            return b
        m = (a * fb - b * fa) / (fb - fa)
        if not a < m < b:
            m = 0.5 * (a + b)
        fm = ptukey(m, k, df) - p
        if abs(fm) < 1e-15:
            return m
        if fm < 0:
            a, fa, fb, side = m, fm, fb / 2 if side < 0 else fb, -1
        else:
            b, fb, fa, side = m, fm, fa / 2 if side > 0 else fa, 1
    return 0.5 * (a + b)


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F distribution."""
    if f is None or not math.isfinite(f) or f <= 0:
        return 1.0 if (f is not None and f <= 0) else float("nan")
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def t_two_sided(t: float, df: float) -> float:
    return betainc(df / 2, 0.5, df / (df + t * t))


@lru_cache(maxsize=1024)
def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t: bisection on the incomplete beta function."""
    if not 0.0 < p < 1.0 or df <= 0:
        return float("nan")
    if p < 0.5:
        return -t_ppf(1.0 - p, df)
    a, b = 0.0, 2.0
    while 1.0 - 0.5 * t_two_sided(b, df) < p:
        a, b = b, 2.0 * b
    for _ in range(200):
        m = 0.5 * (a + b)
        if m in (a, b):
            break
        a, b = (m, b) if 1.0 - 0.5 * t_two_sided(m, df) < p else (a, m)
    return 0.5 * (a + b)


def norm_ppf_array(p) -> np.ndarray:
    """Normal quantiles of an array: Newton steps on the log of the distribution function from a
    rational start, for the lower half (the upper one by symmetry); NaN outside of (0, 1)."""
    p = np.asarray(p, dtype=float)
    ok = (p > 0) & (p < 1)
    low = np.where(ok, np.minimum(p, 1 - p), 0.25)
    t = np.sqrt(-2.0 * np.log(low))
    x = -(t - (2.30753 + 0.27061 * t) / (1.0 + t * (0.99229 + 0.04481 * t)))
    for _ in range(4):
        cdf = norm_cdf(x)
        e = cdf - low
        u = e * math.sqrt(2 * math.pi) * np.exp(0.5 * x * x)
        x = x - u / (1.0 + 0.5 * x * u)                   # Halley's step
    return np.where(ok, np.where(p <= 0.5, x, -x), np.nan)


def poly_contrasts(k: int) -> np.ndarray:
    """Orthonormal polynomial contrasts for ``k`` ordered levels: a ``k x (k-1)`` matrix,
    column j is the degree-(j+1) polynomial in the level scores 1..k, orthogonal to all
    lower degrees and of unit length."""
    scores = np.arange(1, k + 1, dtype=float)
    y = scores - scores.mean()
    X = np.vander(y, k, increasing=True)
    q, r = np.linalg.qr(X)
    raw = q * np.diag(r)
    z = raw / np.sqrt((raw ** 2).sum(axis=0))
    return z[:, 1:]


def ad_pvalue(a2: float, n: int) -> float:
    """p-value of the Anderson-Darling normality statistic (mean and sd estimated), from
    the published piecewise formula on the adjusted statistic A* = A2 (1 + 0.75/n + 2.25/n^2)."""
    aa = a2 * (1 + 0.75 / n + 2.25 / n ** 2)
    if aa < 0.2:
        return 1 - math.exp(-13.436 + 101.14 * aa - 223.73 * aa ** 2)
    if aa < 0.34:
        return 1 - math.exp(-8.318 + 42.796 * aa - 59.938 * aa ** 2)
    if aa < 0.6:
        return math.exp(0.9177 - 4.279 * aa - 1.38 * aa ** 2)
    if aa < 10:
        return math.exp(1.2937 - 5.709 * aa + 0.0186 * aa ** 2)
    return 3.7e-24
