"""Label columns: magnitude range, alert level, risk level, region.

All are plain ``CASE WHEN`` expressions and work unchanged on batch and
streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.config import (
    ALERT_DEFAULT,
    ALERT_STEPS,
    DEFAULT_REGION,
    MAG_RANGE_BOUNDS,
    MAG_RANGE_LABELS,
    OTHER_REGION,
    RISK_DEFAULT,
    RISK_STEPS,
    STREAM_CRITICAL_LABEL,
    Region,
)
from tremor.functions.ladder import ladder
from tremor.functions.numeric import nan_to_null


def mag_range(
    mag: Column,
    bounds: Sequence[float] = MAG_RANGE_BOUNDS,
    labels: Sequence[str] = MAG_RANGE_LABELS,
    null_label: str | None = None,
) -> Column:
    """Bucket a magnitude: below b0, [b0, b1), [b1, b2), [b2, b3] (upper bound
    closed), and everything else in the last label.

    A missing magnitude lands in the last label too, unless ``null_label`` is
    given.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    *open_bounds, closed_bound = bounds
    conditions = [mag < F.lit(b) for b in open_bounds] + [mag <= F.lit(closed_bound)]
    expr = F.when(conditions[0], F.lit(labels[0]))
    for condition, label in zip(conditions[1:], labels[1:]):
        expr = expr.when(condition, F.lit(label))
    expr = expr.otherwise(F.lit(labels[-1]))
    if null_label is not None:
        expr = F.when(mag.isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def alert_level(
    mag: Column,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    default: str = ALERT_DEFAULT,
) -> Column:
    """Alert level on magnitude; missing or NaN magnitude → ``default``."""
    return ladder(nan_to_null(mag), steps, default)


def stream_alert_level(
    mag: Column,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    default: str = ALERT_DEFAULT,
    top_label: str = STREAM_CRITICAL_LABEL,
) -> Column:
    """The stream's alert level: same ladder, top step relabelled, built as one
    ``CASE`` so filters on the label push straight to the magnitude test."""
    relabelled = [(t, top_label if i == 0 else lbl) for i, (t, lbl) in enumerate(steps)]
    return ladder(nan_to_null(mag), relabelled, default)


def risk_level(
    count: Column,
    steps: Sequence[tuple[float, str]] = RISK_STEPS,
    default: str = RISK_DEFAULT,
) -> Column:
    """Risk level of a grid cell from its event count."""
    return ladder(count, steps, default)


def in_region(lat: Column, lon: Column, region: Region = DEFAULT_REGION) -> Column:
    """Closed-box test; null when a coordinate is null."""
    return lat.between(region.min_lat, region.max_lat) & lon.between(region.min_lon, region.max_lon)


def region_label(
    lat: Column, lon: Column, region: Region = DEFAULT_REGION, other: str = OTHER_REGION
) -> Column:
    """Region name for in-box rows, ``other`` otherwise (missing coordinates included)."""
    return F.when(in_region(lat, lon, region), F.lit(region.name)).otherwise(F.lit(other))


def region_flag(region_col: Column, name: str = DEFAULT_REGION.name) -> Column:
    """``region == name``; a null region gives null, not false."""
    return region_col == F.lit(name)
