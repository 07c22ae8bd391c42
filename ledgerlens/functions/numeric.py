"""Numeric column helpers with the semantics the published indicators use.

All helpers build JVM-side expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return _col(c).cast("double")


def round_half_away(c, digits: int) -> Column:
    """Round a double to ``digits`` decimals, ties away from zero, computed as
    ``round(x * 10^n) / 10^n`` in binary floating point.

    Spark's ``round(x, n)`` rounds the shortest decimal text of ``x`` (so
    1.005 becomes 1.01); the indicators are defined on the scaled binary
    value (1.005 * 100 = 100.4999..., so 1.0). Rounding the scaled value to
    an integer is identical in both conventions, but Spark does it through decimal
    text, value by value; here the magnitude is rounded by ``rint``, whose ties that
    went down to an even number (they leave exactly 0.5) are put up by one.

    A negative value that rounds to zero gives -0.0 (as C's ``round`` does).
    """
    scale = F.lit(float(10.0 ** digits))
    scaled = as_double(c) * scale
    size = F.abs(scaled)
    nearest = F.rint(size)
    away = nearest + F.when(size - nearest == F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.signum(scaled) * away / scale


def safe_ratio(num, den) -> Column:
    """``num / den`` in double precision; null when ``den`` is null or 0."""
    return F.try_divide(as_double(num), as_double(den))


def scaled_ratio(factor: float, num, den) -> Column:
    """``factor * num / den``: multiply first, then divide, in double; null
    when ``den`` is null or 0. ``num`` is an exact integer amount."""
    return F.try_divide(F.lit(float(factor)) * as_double(num), as_double(den))


def _two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    """Error-free sum: ``a + b == s + e`` exactly (Knuth's TwoSum)."""
    s = a + b
    bb = s - a
    e = (a - (s - bb)) + (b - bb)
    return s, e


def interpolate(lo, hi, d) -> Column:
    """Continuous-percentile interpolation ``lo * (1 - d) + hi * d`` rounded
    once, as a fused multiply-add would.

    For the quartile positions ``d`` is 0, 0.25, 0.5 or 0.75. Only 0.25
    needs care: ``0.75 * lo`` is inexact, so the sum ``3 * lo + hi`` is
    carried exactly with two error-free additions and divided by 4 (exact).
    For the other fractions one of the two products is exact and the plain
    formula already rounds once.
    """
    lo, hi, d = _col(lo), _col(hi), _col(d)
    s, e = _two_sum(lo * F.lit(2.0), lo)
    t, f = _two_sum(s, hi)
    quarter = (t + (e + f)) / F.lit(4.0)
    plain = lo * (F.lit(1.0) - d) + hi * d
    return (F.when(d == F.lit(0.0), lo)
            .when(d == F.lit(0.25), quarter)
            .otherwise(plain))


def non_finite_to_null(c) -> Column:
    """NaN and +/-infinity become null (JSON-safe output)."""
    c = _col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
