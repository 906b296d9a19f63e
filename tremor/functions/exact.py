"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a sum moves in its last place with the
number of tasks and the order in which they end. Here each value is cut into two
whole numbers of fixed units, 2**-20 and 2**-60, and those are added as decimals:
exact, and the same in any order. One rounding at the end gives the double.

A value below 2**24 in size is represented exactly if it is no finer than
2**-60 (every double from 2**-8 up is), else rounded to that unit by itself. What
is larger, or infinite, is added as doubles beside them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMIT = float(1 << 24)
_UNIT, _FINE = float(1 << 20), float(1 << 60)


def exact_sum_parts(value: Column) -> dict[str, Column]:
    """Aggregates ``high``, ``low`` and ``other`` of a sum; the parts of several
    sums may be added (:func:`add_parts`)."""
    inside = F.abs(value) < F.lit(_LIMIT)
    high = F.rint(value * F.lit(_UNIT))
    low = F.rint((value - high / F.lit(_UNIT)) * F.lit(_FINE))  # the difference is exact

    def whole(part):
        return F.sum(F.when(inside, part).cast("long").cast("decimal(18,0)")).cast("decimal(38,0)")

    return {"high": whole(high), "low": whole(low), "other": F.sum(F.when(~inside, value))}


def add_parts(high: Column, low: Column, other: Column) -> dict[str, Column]:
    """The parts of the sum of several sums."""
    return {"high": F.sum(high).cast("decimal(38,0)"), "low": F.sum(low).cast("decimal(38,0)"), "other": F.sum(other)}


def parts_to_double(high: Column, low: Column, other: Column) -> Column:
    """The sum as a double; null if nothing was added."""
    units = (high * F.lit(1 << 40).cast("decimal(13,0)")).cast("decimal(38,0)") + low
    inside = units.cast("decimal(38,0)").cast("double") / F.lit(_FINE)
    return F.when(high.isNull(), other).otherwise(inside + F.coalesce(other, F.lit(0.0)))


def exact_sum(value: Column) -> Column:
    """Sum of the non-null values, the same in any order; null if there are none."""
    return parts_to_double(**exact_sum_parts(value))


def exact_avg(value: Column) -> Column:
    """Average of the non-null values, the same in any order; null if there are none."""
    return F.try_divide(exact_sum(value), F.count(value).cast("double"))
