"""Normal distribution as Columns (row-sized inputs), chi-square and F tails for result-sized rows.

`normal_cdf` is Hart's rational approximation in West's arrangement (2005), `normal_quantile` is
Wichura's AS 241. Both are single Horner chains, so they stay in generated code. Materialise the
argument as a plain column first: the chains mention it many times.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship the two tail functions by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Published approximation coefficients, highest power first.
HART_TOP = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
HART_BOTTOM = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735823752,
]
WICHURA_CENTRE = (
    [
        2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
        4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
        1.3314166789178437745e2, 3.3871328727963666080e0,
    ],
    [
        5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
        2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
        4.2313330701600911252e1, 1.0,
    ],
)
WICHURA_MIDDLE = (
    [
        7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
        1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
        4.63033784615654529590e0, 1.42343711074968357734e0,
    ],
    [
        1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
        1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
        2.05319162663775882187e0, 1.0,
    ],
)
WICHURA_TAIL = (
    [
        2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
        2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
        5.46378491116411436990e0, 6.65790464350110377720e0,
    ],
    [
        2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
        7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
        5.99832206555887937690e-1, 1.0,
    ],
)


def polynomial(x: Column, coefficients: list[float]) -> Column:
    """Horner evaluation, highest power first."""
    total = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        total = total * x + F.lit(float(c))
    return total


def normal_cdf(z: Column) -> Column:
    size = F.abs(z)
    density = F.exp(-size * size / 2)
    near = density * polynomial(size, HART_TOP) / polynomial(size, HART_BOTTOM)
    fraction = size + 0.65
    for step in (4.0, 3.0, 2.0, 1.0):
        fraction = size + F.lit(step) / fraction
    far = density / fraction / 2.506628274631
    lower = F.when(size > 37, F.lit(0.0)).when(size < 7.07106781186547, near).otherwise(far)
    return F.when(z > 0, 1 - lower).otherwise(lower)


def two_sided_p(z: Column) -> Column:
    return 2 * normal_cdf(-F.abs(z))


def normal_quantile(p: Column) -> Column:
    q = p - 0.5
    centre_arg = F.lit(0.180625) - q * q
    centre = q * polynomial(centre_arg, WICHURA_CENTRE[0]) / polynomial(centre_arg, WICHURA_CENTRE[1])
    r = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(1 - p)))
    middle = polynomial(r - 1.6, WICHURA_MIDDLE[0]) / polynomial(r - 1.6, WICHURA_MIDDLE[1])
    tail = polynomial(r - 5.0, WICHURA_TAIL[0]) / polynomial(r - 5.0, WICHURA_TAIL[1])
    outer = F.when(r <= 5, middle).otherwise(tail)
    return F.when(F.abs(q) <= 0.425, centre).when(q < 0, -outer).otherwise(outer)


def _upper_gamma_ratio(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-17:
            n += 1
            term *= x / n
            total += term
        return 1.0 - scale * total
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return scale * h


def _beta_ratio(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by Lentz's continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_ratio(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h / a


def chi2_tail(stat: float, df: float) -> float:
    return _upper_gamma_ratio(df / 2, stat / 2)


def f_tail(stat: float, df1: float, df2: float) -> float:
    return _beta_ratio(df2 / 2, df1 / 2, df2 / (df2 + df1 * max(stat, 0.0)))


@F.pandas_udf(DoubleType())
def chi2_p(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Upper chi-square tail; only ever applied to one row per test."""
    return pd.Series(
        [None if pd.isna(s) or pd.isna(d) or d <= 0 else chi2_tail(s, d) for s, d in zip(stat, df)],
        dtype="float64",
    )


@F.pandas_udf(DoubleType())
def f_p(stat: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Upper F tail; only ever applied to one row per test."""
    return pd.Series(
        [
            None if pd.isna(s) or pd.isna(a) or pd.isna(b) or a <= 0 or b <= 0 else f_tail(s, a, b)
            for s, a, b in zip(stat, df1, df2)
        ],
        dtype="float64",
    )
