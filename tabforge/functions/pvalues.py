"""Tail probabilities of Student's t and Fisher's F, for the few scalars a test yields."""

from __future__ import annotations

import math


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral, evaluated forwards (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if math.isnan(f) or d2 <= 0:
        return math.nan
    if math.isinf(f):
        return 0.0
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def correlation_p(r: float | None, n: int) -> float:
    """Two-sided p of a (rank) correlation by the t approximation with n-2 df."""
    if r is None or math.isnan(r) or n < 3:
        return math.nan
    if abs(r) >= 1.0:
        return 0.0
    return t_two_sided(r * math.sqrt((n - 2) / (1.0 - r * r)), n - 2)
