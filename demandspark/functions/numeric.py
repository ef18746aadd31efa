"""Numeric column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: Column, digits: int = 0) -> Column:
    """Round half to even on the binary value, the rule of numpy and pandas."""
    if digits == 0:
        return F.rint(col)
    scale = float(10 ** digits)
    return F.rint(col * scale) / scale


def floor_at_zero(col: Column) -> Column:
    """Negative to zero; a null stays null, which ``greatest`` would turn into zero."""
    return F.when(col < 0, F.lit(0)).otherwise(col)


def money(col: Column) -> Column:
    """An amount as a wide decimal; NaN and what does not fit count as missing."""
    return col.try_cast("decimal(28,8)")


def money_sum(col: Column) -> Column:
    """Sum of an amount, exact to eight decimals.

    Decimal sums do not depend on the order of tasks, so a retried stage gives the same total.
    """
    return F.sum(money(col)).cast("double")


def to_units(prediction: Column) -> Column:
    """Model output as a unit count: rounded half to even, never negative."""
    return F.greatest(F.lit(0), F.rint(prediction)).cast("bigint")


def to_millions(col: Column) -> Column:
    return col / 1e6


def clip(col: Column, low: float, high: float) -> Column:
    return F.when(col < low, F.lit(low)).when(col > high, F.lit(high)).otherwise(col.cast("double"))


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for positive arguments: Stirling's series eight places further up."""
    up = z + 8.0
    inverse = 1.0 / up
    square = inverse * inverse
    # Terms of Stirling's series.
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
    rising = F.lit(1.0)
    for k in range(8):
        rising = rising * (z + float(k))
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + series - F.log(rising)


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function, by the modified method of Lentz."""
    tiny = 1e-300

    def kept(v):
        return F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def term(state, factor):
        c, d = kept(1.0 + factor / state["c"]), 1.0 / kept(1.0 + factor * state["d"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    first = 1.0 / kept(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def step(state, i):
        m = F.floor((i + 1) / 2).cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return term(state, F.when(i % 2 == 1, even).otherwise(odd))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * steps)), start, step)["h"]


def regularised_beta(a: Column, b: Column, x: Column, rest: Column | None = None, steps: int = 60) -> Column:
    """The regularised incomplete beta function for x from 0 to 1; the side where the fraction settles fast is used.

    ``rest`` is 1 - x, for callers that know it without loss of digits.
    """
    rest = 1.0 - x if rest is None else rest
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(rest))
    near, far = front * _beta_fraction(a, b, x, steps) / a, 1.0 - front * _beta_fraction(b, a, rest, steps) / b
    return F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).when(x < (a + 1.0) / (a + b + 2.0), near).otherwise(far)


def student_two_sided_p(t: Column, degrees: Column) -> Column:
    """Two-sided tail of Student's t."""
    return regularised_beta(degrees / 2.0, F.lit(0.5), degrees / (degrees + t * t), t * t / (degrees + t * t))
