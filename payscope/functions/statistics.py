"""Statistical expressions. All aggregates here merge partial results, so a hot key
is reduced on the map side before any shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column) -> Column:
    """``sum(value * weight) / sum(weight)``; NULL when the weights sum to zero."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def relative_gap(a: Column, b: Column) -> Column:
    """``a / b - 1``; NULL when b is zero or either is missing."""
    return F.try_divide(a, b) - F.lit(1.0)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; NULL for a constant input.
    ``corr`` divides by zero there under ANSI mode."""
    both = x.isNotNull() & y.isNotNull()
    px = F.when(both, x.cast("double"))
    py = F.when(both, y.cast("double"))
    r = F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
    # Rounding noise past the bounds is cut; the test keeps NULL, which ``least`` drops.
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pair_count(x: Column, y: Column) -> Column:
    return F.count_if(x.isNotNull() & y.isNotNull())


def _half_step_gamma_ratio(a: Column) -> Column:
    """Gamma(a + 1/2) / Gamma(a) for a > 0: the asymptotic series at a + 10, brought
    back to a with the recurrence of the gamma function."""
    # Published coefficients of the series in 1/z, lowest power first.
    coefficients = (
        1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304,
    )
    shift = 10
    z = a + F.lit(float(shift))
    ratio = F.lit(0.0)
    for k in reversed(coefficients):
        ratio = ratio / z + F.lit(k)
    ratio = ratio * F.sqrt(z)
    for i in range(shift):
        ratio = ratio * (a + F.lit(float(i))) / (a + F.lit(i + 0.5))
    return ratio


# Terms of the continued fractions and series. With one argument 1/2 and the side of the
# distribution chosen as below, they settle in fewer up to _MANY degrees of freedom; past
# that the fraction's terms nearly cancel, and the normal limit with its corrections,
# whose error falls with the square of the degrees, is the more exact one.
_TERMS = 64
_MANY = 1e5


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, evaluated forward (the
    modified Lentz recurrence)."""

    def step(state: Column, k: Column) -> Column:
        a, b, m = state["a"], state["b"], F.floor(k / F.lit(2)).cast("double")
        even = m * (b - m) / ((a + m * 2 - 1) * (a + m * 2))
        odd = -(a + m) * (a + b + m) / ((a + m * 2) * (a + m * 2 + 1))
        numerator = state["x"] * F.when(k % 2 == 0, even).otherwise(odd)
        d = F.try_divide(F.lit(1.0), F.lit(1.0) + numerator * state["d"])
        c = F.lit(1.0) + F.try_divide(numerator, state["c"])
        return F.struct(
            a.alias("a"),
            b.alias("b"),
            state["x"].alias("x"),
            c.alias("c"),
            d.alias("d"),
            (state["h"] * c * d).alias("h"),
        )

    # The arguments travel in the state, so each is computed once and not per term.
    start = F.struct(
        a.alias("a"),
        b.alias("b"),
        x.alias("x"),
        F.lit(1e300).alias("c"),
        F.lit(1.0).alias("d"),
        F.lit(1.0).alias("h"),
    )
    terms = F.sequence(F.lit(1), F.lit(_TERMS))
    return F.aggregate(terms, start, step, lambda state: state["h"])


def _two_sided_normal(u: Column) -> Column:
    """Probability that a normal deviate exceeds ``u`` >= 0 in size, to full relative
    precision: a series of positive terms near zero, a continued fraction in the tail."""
    # Everything travels in the state, so each is computed once and not per term.
    start = F.struct(u.alias("u"), u.alias("term"), u.alias("sum"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        start,
        lambda s, k: F.struct(
            s["u"].alias("u"),
            (s["term"] * s["u"] * s["u"] / (k * 2 + 1)).alias("term"),
            (s["sum"] + s["term"] * s["u"] * s["u"] / (k * 2 + 1)).alias("sum"),
        ),
        lambda s: F.lit(1.0) - s["sum"] * F.exp(s["u"] * s["u"] / -2) * math.sqrt(2 / math.pi),
    )
    fraction = F.aggregate(
        F.sequence(F.lit(4 * _TERMS), F.lit(1), F.lit(-1)),
        F.struct(u.alias("u"), u.alias("f")),
        lambda s, k: F.struct(s["u"].alias("u"), (s["u"] + k / s["f"]).alias("f")),
        lambda s: F.exp(s["u"] * s["u"] / -2) * math.sqrt(2 / math.pi) / s["f"],
    )
    return F.when(u < 2, series).otherwise(fraction)


def _many_pairs(r: Column, degrees: Column) -> Column:
    """The p-value by Hill's transform of t to a normal deviate."""
    a = degrees - 0.5
    b = a * a * 48
    z2 = -a * F.log1p(-r * r)
    z = F.sqrt(z2)
    second = (((z2 * 4 + 33) * z2 + 240) * z2 + 855) * z / ((z2 * z2 * 0.8 + b + 100) * b * 10)
    return _two_sided_normal(z + (z2 + 3) * z / b - second)


def pearson_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation ``r`` over ``n`` pairs: the probability that
    Student's t with n - 2 degrees of freedom exceeds ``|r| sqrt((n-2) / (1-r^2))``,
    that is the regularised incomplete beta I(1 - r^2; (n-2)/2, 1/2).

    Small values come from the tail itself, so they keep their digits. The work is a
    constant per result row, whatever n; so is the precision. NULL for n < 3; zero for a perfect correlation.
    """
    half = F.lit(0.5)
    a = (n.cast("double") - 2) / 2
    r2 = r * r
    tail = (r2 * (a + 2.5) >= 3) | (r2 >= 0.5)
    fraction = _beta_fraction(
        F.when(tail, a).otherwise(half),
        F.when(tail, half).otherwise(a),
        F.when(tail, F.lit(1.0) - r2).otherwise(r2),
    )
    mass = (
        F.exp(a * F.log1p(-r2)) * F.abs(r) * _half_step_gamma_ratio(a)
        * F.lit(1 / math.sqrt(math.pi)) * fraction
    )
    # I(x; a, b) in the tail and 1 - I(1 - x; b, a) elsewhere, with the mass written once.
    p = F.when(tail, F.lit(0.0)).otherwise(F.lit(1.0)) + mass * F.when(
        tail, F.lit(1.0) / a
    ).otherwise(F.lit(-1.0) / half)
    return (
        F.when((n < 3) | r.isNull(), F.lit(None).cast("double"))
        .when(F.abs(r) >= 1, F.lit(0.0))
        .when(n > _MANY, _many_pairs(r, n.cast("double") - 2))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    )
