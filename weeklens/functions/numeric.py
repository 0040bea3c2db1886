"""Numeric column expressions: guarded arithmetic, normal and chi-square distributions."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_value(probability: float) -> float:
    """Standard normal quantile of a plan-time parameter."""
    return NormalDist().inv_cdf(probability)


def null_if_nan(c: Column) -> Column:
    """Missing values are NULL everywhere; Spark's avg would propagate NaN."""
    return F.nanvl(c, F.lit(None).cast("double"))


def clip_zero(c: Column) -> Column:
    """max(c, 0) that keeps NULL (``greatest`` alone would turn it into 0)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), c))


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is zero."""
    return num / F.nullif(den, F.lit(0.0))


def normal_density(z: Column) -> Column:
    return F.exp(-z * z / 2.0) / F.lit(math.sqrt(2 * math.pi))


# Rational approximation AS 241 (Wichura 1988), centre, middle and tail.
_CENTRE_NUM = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3,
)
_CENTRE_DEN = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3,
)
_MIDDLE_NUM = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
    1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
_MIDDLE_DEN = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
)
_TAIL_NUM = (
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
    2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7,
)
_TAIL_DEN = (
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15,
)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile of a probability column; NULL outside (0, 1)."""
    q = p - F.lit(0.5)
    centre_x = F.lit(0.180625) - q * q
    centre = q * _polynomial(_CENTRE_NUM, centre_x) / _polynomial(_CENTRE_DEN, centre_x)
    tail_p = F.when(q < 0, p).otherwise(F.lit(1.0) - p)
    root = F.sqrt(-F.ln(tail_p))
    near, far = root - F.lit(1.6), root - F.lit(5.0)
    size = F.when(root <= 5.0, _polynomial(_MIDDLE_NUM, near) / _polynomial(_MIDDLE_DEN, near)).otherwise(
        _polynomial(_TAIL_NUM, far) / _polynomial(_TAIL_DEN, far)
    )
    signed = F.when(q < 0, -size).otherwise(size)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, centre).otherwise(signed))


def chi_square_tail(x: Column, df: int) -> Column:
    """P(X > x) for a chi-square variable with ``df`` degrees of freedom."""
    half = x / 2.0
    if df % 2 == 0:
        # exp(-x/2) * sum_{k < df/2} (x/2)^k / k!
        zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
        tail = F.aggregate(
            F.sequence(F.lit(1), F.lit(df // 2)),
            zero,
            lambda s, k: F.struct((s["term"] * half / k).alias("term"), (s["total"] + s["term"]).alias("total")),
            lambda s: s["total"],
        )
        return F.exp(-half) * tail
    # Odd df: one minus the lower series, summed well past its largest term (which sits near x/2).
    a = df / 2.0
    start = F.exp(F.lit(a) * F.ln(half) - half - F.lit(math.lgamma(a + 1.0)))
    last = (F.lit(60) + F.ceil(half * 2.0 + F.sqrt(half) * 12.0)).cast("int")
    zero = F.struct(start.alias("term"), start.alias("total"))
    lower = F.aggregate(
        F.sequence(F.lit(1), last),
        zero,
        lambda s, k: F.struct(
            (s["term"] * half / (F.lit(a) + k)).alias("term"),
            (s["total"] + s["term"] * half / (F.lit(a) + k)).alias("total"),
        ),
        lambda s: s["total"],
    )
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - lower))
