"""Number rules shared by every report.

Money is DECIMAL, so sums are exact in any order. Rounded money is rounded as a
decimal (half away from zero) and only then turned into DOUBLE. Ratios and
averages are rounded from the *exact* quotient with integer arithmetic, so the
result does not depend on how an engine rounds a binary double at a tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.schema import MONEY, RATE

_INT = T.DecimalType(38, 0)


def money(c) -> Column:
    """Cast to DECIMAL(18,2) (the money type)."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def rate(c) -> Column:
    """Cast to DECIMAL(9,4) (discount rates)."""
    return F.col(c).cast(RATE) if isinstance(c, str) else c.cast(RATE)


def round_money(c: Column, digits: int = 2) -> Column:
    """ROUND(decimal, n) half away from zero, then DOUBLE."""
    return F.round(c, digits).cast(T.DoubleType())


def round_near(c: Column, digits: int) -> Column:
    """ROUND of a DOUBLE that has no exact form, nudged off ties so that engines agree."""
    return F.round(c + F.signum(c) * F.lit(1e-9), digits)


def _scaled_int(c: Column, scale: int) -> Column:
    """Exact integer value of ``c * 10**scale`` (c has at most ``scale`` decimals)."""
    if scale:
        c = c * F.lit(10 ** scale)
    return c.cast(_INT)


def exact_int_div(n: Column, d: Column) -> Column:
    """Floor of n / d for non-negative integral decimals, exactly (SQL ``div``)."""
    return F.call_function("div", n, d)


def round_div(num: Column, den: Column, digits: int, factor: int = 1,
              num_scale: int = 0, den_scale: int = 0) -> Column:
    """ROUND(factor * num / den, digits) of the exact quotient, half away from zero.

    ``num_scale``/``den_scale`` are the number of decimals the inputs carry
    (2 for money, 0 for counts). NULL when ``den`` is 0 or NULL (the NULLIF
    guard of the reference). Result is DOUBLE.
    """
    a, b = _operands(num, den, digits, factor, num_scale, den_scale)
    q = exact_int_div(F.abs(a) * 2 + F.abs(b), F.abs(b) * 2)
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    return F.when(b != 0, signed.cast(T.DoubleType()) / F.lit(float(10 ** digits)))


def _operands(num: Column, den: Column, digits: int, factor: int, num_scale: int,
              den_scale: int) -> tuple[Column, Column]:
    """Integers A, B with A / B = factor * num / den * 10**digits.

    num = N / 10**num_scale and den = M / 10**den_scale for integers N, M, so
    A = N * factor * 10**(digits + den_scale) and B = M * 10**num_scale.
    """
    a = _scaled_int(num, num_scale) * F.lit(factor * 10 ** (digits + den_scale))
    b = _scaled_int(den, den_scale)
    if num_scale:
        b = b * F.lit(10 ** num_scale)
    return a, b


def round_div_decimal(num: Column, den: Column, digits: int,
                      num_scale: int = 0, den_scale: int = 0) -> Column:
    """Like :func:`round_div` but returns DECIMAL(38, digits) (exact)."""
    a, b = _operands(num, den, digits, 1, num_scale, den_scale)
    q = exact_int_div(F.abs(a) * 2 + F.abs(b), F.abs(b) * 2)
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q).cast(_INT)
    return F.when(b != 0, (signed / F.lit(10 ** digits)).cast(T.DecimalType(38, digits)))


def pct_text(c: Column) -> Column:
    """``CAST(x AS TEXT) || '%'`` for a value already rounded to 1 decimal.

    NULL stays NULL so that a COALESCE around it can supply a default.
    Adding 0.0 turns a negative zero into zero.
    """
    return F.when(c.isNotNull(), F.format_string("%.1f%%", c + F.lit(0.0)))


def to_double(c: Column) -> Column:
    return c.cast(T.DoubleType())
