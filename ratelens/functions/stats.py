"""Statistical column expressions (P19, W3, W4) kept inside Spark's codegen.

Neither Spark nor ANSI SQL ships a normal CDF. The two-sided tail has two methods: ``polynomial``, the
approximation of Abramowitz & Stegun 26.2.17 (max error ~1e-7), and ``exact``, the complementary
error function by Cody's rational approximations (relative error near the double's precision, far tail
included, where 1 - CDF would be 0).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from .columns import col

SQRT_2PI = math.sqrt(2.0 * math.pi)


def normal_two_sided_p(abs_z: str | Column) -> Column:
    """2 * (1 - Phi(|z|)) by the A&S polynomial."""
    z = col(abs_z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(C.NORMAL_TAIL_P) * z)
    b1, b2, b3, b4, b5 = C.NORMAL_TAIL_B
    poly = t * (F.lit(b1) + t * (F.lit(b2) + t * (F.lit(b3) + t * (F.lit(b4) + t * F.lit(b5)))))
    return F.lit(2.0) * poly * F.exp(F.lit(-0.5) * (z * z)) / F.lit(SQRT_2PI)


# FIXED VALUES: W. J. Cody, "Rational Chebyshev approximations for the error function" (1969).
# Highest power first; erf(x) = x * P(x^2) / Q(x^2) up to ERF_NEAR, erfc(x) = exp(-x^2) * P(x) / Q(x)
# up to ERF_FAR, beyond it erfc(x) = exp(-x^2) / x * (1 / sqrt(pi) - y * P(y) / Q(y)) with y = 1 / x^2.
ERF_NEAR, ERF_FAR = 0.46875, 4.0
ERF_P = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2,
         3.20937758913846947e3)
ERF_Q = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
ERFC_P = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1,
          2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3,
          1.23033935479799725e3)
ERFC_Q = (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
          3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3)
TAIL_P = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
          1.60837851487422766e-2, 6.58749161529837803e-4)
TAIL_Q = (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2,
          2.33520497626869185e-3)

P_METHODS = ("polynomial", "exact")


def _horner(coefficients: tuple[float, ...], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def erfc(x: str | Column) -> Column:
    """The complementary error function of x >= 0; a null gives null, a NaN gives NaN."""
    x = col(x)
    square = x * x
    near = F.lit(1.0) - x * _horner(ERF_P, square) / _horner(ERF_Q, square)
    middle = F.exp(-square) * _horner(ERFC_P, x) / _horner(ERFC_Q, x)
    y = F.lit(1.0) / F.greatest(square, F.lit(1.0))  # only read beyond ERF_FAR; never a division by 0
    far = F.exp(-square) / F.greatest(x, F.lit(1.0)) * (
        F.lit(1.0 / math.sqrt(math.pi)) - y * _horner(TAIL_P, y) / _horner(TAIL_Q, y))
    return F.when(x <= F.lit(ERF_NEAR), near).when(x <= F.lit(ERF_FAR), middle).otherwise(far)


def two_sided_p(abs_z: str | Column, method: str = "polynomial") -> Column:
    """The normal distribution's mass beyond |z| on both sides."""
    if method not in P_METHODS:
        raise ValueError(f"method must be one of {P_METHODS}, got {method!r}")
    z = col(abs_z)
    return normal_two_sided_p(z) if method == "polynomial" else erfc(z * F.lit(math.sqrt(0.5)))


def two_proportion_abs_z(count1: str | Column, nobs1: str | Column,
                         count2: str | Column, nobs2: str | Column) -> Column:
    """P19's statistic: |z| of the pooled two-proportion test; null where it is not defined (an empty
    sample, a pooled rate of 0 or 1)."""
    c1, n1 = col(count1).cast("double"), col(nobs1).cast("double")
    c2, n2 = col(count2).cast("double"), col(nobs2).cast("double")
    pool = F.try_divide(c1 + c2, n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.abs(F.try_divide(F.try_divide(c1, n1) - F.try_divide(c2, n2), se))


def with_p_value(df: DataFrame, count1: str, nobs1: str, count2: str, nobs2: str, name: str = "p_value",
                 method: str = "exact") -> DataFrame:
    """``df`` with P19's p-value by either method; 1.0 where the statistic is not defined.

    The statistic is a column of its own first: the rational forms read it some fifty times.
    """
    with_z = df.withColumn("_abs_z", two_proportion_abs_z(count1, nobs1, count2, nobs2))
    return with_z.withColumn(name, F.coalesce(two_sided_p("_abs_z", method), F.lit(1.0))).drop("_abs_z")


def two_proportion_p_value(count1: str | Column, nobs1: str | Column,
                           count2: str | Column, nobs2: str | Column) -> Column:
    """Pooled two-proportion z-test, two-sided p.

    1.0 when either sample is empty, the pooled rate is 0 or 1, or se is 0.
    """
    c1, n1 = col(count1).cast("double"), col(nobs1).cast("double")
    c2, n2 = col(count2).cast("double"), col(nobs2).cast("double")
    p1 = F.try_divide(c1, n1)
    p2 = F.try_divide(c2, n2)
    pool = F.try_divide(c1 + c2, n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    abs_z = F.abs(F.try_divide(p1 - p2, se))
    return (F.when((n1 == 0) | (n2 == 0), F.lit(1.0))
            .when((pool == 0.0) | (pool == 1.0), F.lit(1.0))
            .when(se == 0.0, F.lit(1.0))
            .otherwise(normal_two_sided_p(abs_z)))


def standardize(x: str | Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std, all zeros when std is 0."""
    return F.when(std == 0.0, F.lit(0.0)).otherwise((col(x) - mean) / std)


def min_max_normalise(x: str | Column, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min), all zeros when max == min."""
    return F.when(hi == lo, F.lit(0.0)).otherwise((col(x) - lo) / (hi - lo))
