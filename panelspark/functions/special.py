"""Tail probabilities for result rows: normal, Student t, chi-square. Continued fractions and series as published."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x <= 0:
        return 1.0
    a, x = dof / 2, x / 2
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * scale)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def beta_regularised(x: float, a: float, b: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_regularised(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(10_000):
        m = i // 2
        top = 1.0 if i == 0 else (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))
        d = 1 / (1 + top * d or 1e-30)
        c = 1 + top / c or 1e-30
        f *= c * d
        if abs(1 - c * d) < 1e-15:
            break
    return front * (f - 1)


def t_two_sided(t: float, dof: float) -> float:
    return beta_regularised(dof / (dof + t * t), dof / 2, 0.5)
