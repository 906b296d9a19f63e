"""Numeric coercion and grid snapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import GRID_DIGITS


def nan_to_null(value: Column) -> Column:
    """Treat NaN as missing (Spark orders NaN above every number, so a NaN
    magnitude would otherwise compare greater than any threshold)."""
    return F.nanvl(value, F.lit(None).cast("double"))


# Decimal, exponent and infinity spellings; Java's own ones (5d, 0x1p3) are not numbers here.
_NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def to_double(value: Column, source_type: T.DataType | None = None) -> Column:
    """Lenient numeric coercion: unparseable text becomes null, never an error.

    Uses ``try_cast`` so a bad value cannot abort a job under ANSI mode, then
    maps NaN to null. One rule for batch and stream: decimal and exponent
    spellings and infinities are numbers, everything else is missing.
    """
    if isinstance(source_type, T.DoubleType):
        return nan_to_null(value)
    if isinstance(source_type, (T.FloatType, T.IntegralType, T.DecimalType)):
        return nan_to_null(value.cast("double"))
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def grid_snap(value: Column, digits: int = GRID_DIGITS, mode: str = "half_up") -> Column:
    """Round a coordinate onto the grid.

    ``half_up`` is SQL ``round`` (the distributed hotspot job); ``half_even``
    is how pandas rounds a float column (the single-process top-cells view),
    see :func:`round_half_even`.
    """
    if mode == "half_up":
        return F.round(value, digits)
    if mode == "half_even":
        return round_half_even(value, digits)
    raise ValueError(f"unknown rounding mode {mode!r}; expected 'half_up' or 'half_even'")


def round_half_even(value: Column, digits: int) -> Column:
    """Round the way Python's ``round`` and numpy's ``around`` treat a float:
    scale by ``10**digits``, round half to even, scale back. An exact binary
    tie such as 4.125 goes to 4.12 (SQL ``round`` gives 4.13). The one
    remaining difference from Python's ``round`` is a value whose scaling
    itself lands on a tie (2.675 × 100 is exactly 267.5 in floating point).
    Adding 0.0 turns the -0.0 that rounding a small negative value gives into
    0.0, so equal cells always print alike."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale + F.lit(0.0)


def round_like_python(value: Column, digits: int) -> Column:
    """Python's ``round(x, digits)`` on a float, exactly: round half to even on
    the exact binary value of ``x`` (2.675 is stored as 2.67499999… and
    gives 2.67).

    The scaled value ``p = x * 10**digits`` is rounded half to even as in
    :func:`round_half_even`, except when ``p`` lands exactly on a tie: then the
    exact rounding error of that product (Dekker's error-free product, splitting
    ``x`` into two halves that multiply exactly) decides the direction. Plain
    double arithmetic, no UDF.
    """
    scale = float(10**digits)
    x = value
    p = x * F.lit(scale)
    t = x * F.lit(134217729.0)  # 2**27 + 1: splits x into 26-bit halves
    high = t - (t - x)
    low = x - high
    error = (high * F.lit(scale) - p) + low * F.lit(scale)  # x*scale == p + error, exactly
    floor = F.floor(p).cast("double")
    tie = (p - floor) == F.lit(0.5)
    k = F.when(tie & (error > 0), floor + 1).when(tie & (error < 0), floor).otherwise(F.rint(p))
    # NaN, infinities and |p| >= 2**52 (no fractional digits left) pass through,
    # which also keeps floor() inside bigint range under ANSI mode.
    whole = F.isnan(x) | (F.abs(p) >= F.lit(float(2**52)))
    return F.when(whole, x).otherwise(k / F.lit(scale) + F.lit(0.0))
