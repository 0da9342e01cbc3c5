"""Numeric text parsing and arithmetic with the survey's semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plain decimal-number shape accepted by the int32
# parse (sign, digits, optional fraction; no exponent, no separators).
INT_TEXT = r"^[+-]?[0-9]+([.][0-9]*)?$"

INT32_MIN = -2147483648
INT32_SPAN = 4294967296


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int32(s) -> Column:
    """Parse text as a 32-bit integer, truncating any fraction.

    ``'1000.50'`` → 1000, ``'-1.9'`` → -1; overflow, exponents and
    garbage give null instead of failing the job.
    """
    s = _col(s)
    return F.when(
        s.rlike(INT_TEXT),
        s.try_cast("decimal(38,10)").try_cast("int"),
    )


def to_double(s) -> Column:
    """Parse text as a finite double; garbage, ``NaN``, infinities and
    magnitudes beyond a double give null."""
    d = _col(s).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def wrap_int32(x) -> Column:
    """Two's-complement wrap of a bigint into the int32 range.

    Reproduces 32-bit multiplication overflow explicitly, so ANSI mode
    can stay on for everything else.
    """
    x = _col(x).cast("bigint")
    return (F.pmod(x - F.lit(INT32_MIN), F.lit(INT32_SPAN)) + F.lit(INT32_MIN)).cast("int")


def round_half_up(x, scale: int) -> Column:
    """Round a double half-up at ``scale`` decimals via a decimal.

    Going through ``decimal(38,9)`` makes the result independent of the
    binary representation, so two engines round the same way. Doubles of
    2^53 and above have no decimals and stay as they are, as do NaN and
    infinities.
    """
    x = _col(x).cast("double")
    small = ~F.isnan(x) & (F.abs(x) < float(1 << 53))
    return F.when(small, F.round(x.try_cast("decimal(38,9)"), scale).cast("double")).otherwise(x)


def safe_div(num, den, default: float) -> Column:
    """``num / den``, or ``default`` when the denominator is zero."""
    num, den = _col(num), _col(den)
    return F.when(den != 0, num / den).otherwise(F.lit(default))
