"""Tail probabilities and quantiles for the few scalars a test or interval needs."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta integral."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 2000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or df <= 0:
        return math.nan
    return 0.0 if math.isinf(t) else beta_cdf(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if math.isnan(f) or d2 <= 0:
        return math.nan
    return 0.0 if math.isinf(f) else beta_cdf(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * max(f, 0.0)))


def chi2_upper(x: float, df: float) -> float:
    """Upper tail of chi-square: series below the mean, continued fraction above."""
    if x <= 0.0:
        return 1.0
    a, z = df / 2.0, x / 2.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= z / k
            total += term
        return 1.0 - front * total
    b, c = z + 1.0 - a, 1e300
    d = out = 1.0 / b
    for i in range(1, 10000):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b)
        c = b + step / c
        out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * out


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def t_quantile(p: float, df: float) -> float:
    """Student-t quantile by bisection on the two-sided tail."""
    if df <= 0:
        return math.nan
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    tail = 2.0 * (1.0 - p)
    lo, hi = 0.0, 2.0
    while t_two_sided(hi, df) > tail:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if mid in (lo, hi):
            break
        if t_two_sided(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


# Degrees of freedom up to which the quantile column reads a table.
TABLED = 200


def t_quantile_column(p: float, df: Column) -> Column:
    """Student-t quantile for a column of whole degrees of freedom; NULL below 1.

    Few degrees are looked up among quantiles worked out beforehand; beyond, the
    expansion about the normal quantile (Abramowitz & Stegun 26.7.5) errs by less
    than 1e-10.
    """
    z = normal_quantile(p)
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    far, power = F.lit(z), df.cast("double")
    for k, g in enumerate(terms, start=1):
        far = far + F.lit(g) / F.pow(power, F.lit(float(k)))
    table = F.array(*[F.lit(t_quantile(p, n)) for n in range(1, TABLED + 1)])
    whole = df.cast("int")
    return F.when(df > TABLED, far).when(df >= 1, F.get(table, whole - 1))
