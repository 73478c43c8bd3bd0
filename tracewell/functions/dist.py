"""Tail probabilities of the usual distributions, in numpy alone."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if not (x == x and a > 0 and b > 0):
        return math.nan
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 1000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * value


def t_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else (0.0 if math.isinf(t) else math.nan)


def f_upper(f: float, df1: float, df2: float) -> float:
    return incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)) if f == f and f >= 0 else math.nan


def t_quantile(p: float, df: float) -> float:
    """Upper quantile by bisection on the two-sided tail."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > 2 * (1 - p) and high < 1e12:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_two_sided(mid, df) > 2 * (1 - p) else (low, mid)
    return (low + high) / 2


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_upper(x: float, df: float) -> float:
    """Regularised upper incomplete gamma of df / 2 at x / 2."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for n in range(1, 10_000):
            term *= x / (a + n)
            total += term
            if term < total * 1e-16:
                break
        return 1 - total * scale
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for n in range(1, 10_000):
        an = -n * (n - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return scale * h


def kolmogorov_upper(d: float, n: float) -> float:
    """Asymptotic tail of the two-sample statistic, n the harmonic size n1 n2 / (n1 + n2)."""
    x = d * math.sqrt(n)
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


@lru_cache(maxsize=256)
def _rank_sum_counts(n1: int, n2: int) -> np.ndarray:
    """Ways to reach each value of the rank-sum statistic W (from 0 to n1 n2), as shares."""
    ways = np.zeros((n1 + 1, n1 * n2 + 1))
    ways[0, 0] = 1
    for value in range(1, n1 + n2 + 1):
        for k in range(min(n1, value), 0, -1):
            shift = value - k
            if shift <= n2:
                ways[k, shift:] += ways[k - 1, : ways.shape[1] - shift] if shift else ways[k - 1]
    return ways[n1] / ways[n1].sum()


def rank_sum_exact(w: float, n1: int, n2: int) -> float:
    share = _rank_sum_counts(n1, n2)
    k = int(round(w))
    return min(1.0, 2 * float(share[k:].sum() if w > n1 * n2 / 2 else share[: k + 1].sum()))


def rank_sum_normal(w: float, n1: int, n2: int, ties: float) -> float:
    """Normal tail with continuity correction; `ties` is the sum of t**3 - t."""
    z = w - n1 * n2 / 2
    n = n1 + n2
    sigma = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    return math.nan if sigma == 0 else min(1.0, 2 * normal_upper(abs(z - math.copysign(0.5, z) * (z != 0)) / sigma))


@lru_cache(maxsize=256)
def _signed_rank_counts(n: int) -> np.ndarray:
    ways = np.zeros(n * (n + 1) // 2 + 1)
    ways[0] = 1
    for k in range(1, n + 1):
        ways[k:] = ways[k:] + ways[:-k].copy()
    return ways / ways.sum()


def signed_rank_exact(v: float, n: int) -> float:
    share = _signed_rank_counts(n)
    k = int(round(v))
    return min(1.0, 2 * float(share[k:].sum() if v > n * (n + 1) / 4 else share[: k + 1].sum()))


def signed_rank_normal(v: float, n: int, ties: float) -> float:
    z = v - n * (n + 1) / 4
    sigma = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    return math.nan if sigma == 0 else min(1.0, 2 * normal_upper(abs(z - math.copysign(0.5, z) * (z != 0)) / sigma))


def studentised_range_upper(q: float, k: int, df: float) -> float:
    """Tail of the studentised range of k means by two Gauss-Legendre rules."""
    if q <= 0 or k < 2:
        return 1.0
    x, w = _legendre(96)
    z = 8 * x  # the standard normal of the smallest mean, cut at eight deviations

    def inner(r: np.ndarray) -> np.ndarray:
        low = 0.5 * (1 + _erf(z[None, :] / math.sqrt(2)))
        high = 0.5 * (1 + _erf((z[None, :] + r[:, None]) / math.sqrt(2)))
        return k * (8 * w[None, :] * np.exp(-(z[None, :] ** 2) / 2) / math.sqrt(2 * math.pi) * (high - low) ** (k - 1)).sum(1)

    if not math.isfinite(df) or df > 1e5:
        return float(min(1, max(0, 1 - inner(np.array([q]))[0])))
    spread = 1 / math.sqrt(2 * df)
    low, high = max(1e-6, 1 - 9 * spread), 1 + 12 * spread
    s = low + (high - low) * (x + 1) / 2
    density = np.exp(math.log(2) + df / 2 * math.log(df / 2) - math.lgamma(df / 2) + (df - 1) * np.log(s) - df * s * s / 2)
    return float(min(1, max(0, 1 - ((high - low) / 2 * w * density * inner(q * s)).sum())))


@lru_cache(maxsize=8)
def _legendre(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.polynomial.legendre.leggauss(n)


_erf = np.vectorize(math.erf)
