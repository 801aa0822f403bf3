"""Tail probabilities of the t and F distributions as column expressions.

Both are regularised incomplete beta functions.  The continued fraction is
evaluated from its last term to its first by a fold over a sequence, with more
terms the larger the degrees of freedom; log-gamma is Stirling's series eight
steps up.  Everything stays in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 8


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for positive ``z``."""
    up = z + _STEPS
    series = ((up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * F.pow(up, 3.0))
              + 1 / (1260 * F.pow(up, 5.0)) - 1 / (1680 * F.pow(up, 7.0)) + 1 / (1188 * F.pow(up, 9.0)))
    below = z
    for k in range(1, _STEPS):
        below = below * (z + k)
    return series - F.log(below)


def _term(p: Column, q: Column, k: Column) -> Column:
    """Coefficient ``k`` of the continued fraction of the incomplete beta function."""
    m = F.floor(k / 2).cast("double")
    even = m * (q - m) / ((p + 2 * m - 1) * (p + 2 * m))
    odd = -(p + m) * (p + q + m) / ((p + 2 * m) * (p + 2 * m + 1))
    return F.when(k % 2 == 0, even).otherwise(odd)


def _lower_part(p: Column, q: Column, u: Column, v: Column) -> Column:
    """I_u(p, q) with v = 1 - u, for ``u`` up to the mean of the distribution."""
    terms = (F.ceil(F.sqrt(F.greatest(p, q))) * 4 + 64).cast("int")
    fraction = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0),
                           lambda t, k: F.coalesce(1 + F.try_divide(_term(p, q, k) * u, t), F.lit(1.0)))
    front = F.exp(p * F.log(u) + q * F.log(v) + log_gamma(p + q) - log_gamma(p) - log_gamma(q))
    return F.try_divide(front / p, fraction)


def incomplete_beta(a: Column, b: Column, x: Column, rest: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), ``rest`` = 1 - x (given apart,
    so that neither end loses digits); null outside its range."""
    small = x * (a + b + 2) < a + 1
    inner = F.when(small, _lower_part(a, b, x, rest)).otherwise(1 - _lower_part(b, a, rest, x))
    value = F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).otherwise(inner)
    valid = (a > 0) & (b > 0) & (x >= 0) & (rest >= 0) & ~F.isnan(x)
    return F.when(valid, F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of the F distribution; null for degrees of freedom below 1."""
    f, d1, d2 = (c.cast("double") for c in (f, d1, d2))
    total = F.nullif(d2 + d1 * f, F.lit(0.0))
    return F.when((d1 > 0) & (d2 > 0), incomplete_beta(d2 / 2, d1 / 2, F.try_divide(d2, total), F.try_divide(d1 * f, total)))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided tail of Student's t: its square is F with 1 and ``dof``."""
    return f_pvalue(t * t, F.lit(1.0), dof)
