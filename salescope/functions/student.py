"""Student t tail probabilities and quantiles for coefficient tables."""

from __future__ import annotations

from math import exp, lgamma, log, log1p


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def two_sided_p(t: float, df: float) -> float:
    return regularized_beta(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Upper quantile (p > 0.5) by bisection on the tail probability."""
    lo, hi = 0.0, 1.0
    while two_sided_p(hi, df) / 2.0 > 1.0 - p:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if two_sided_p(mid, df) / 2.0 > 1.0 - p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0
