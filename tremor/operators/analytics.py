"""Catalog aggregates: counts by magnitude range / region / place, regional
statistics and the one-pass summary row.

Every aggregate is algebraic (count, sum/avg, max, min), so Spark plans a
partial aggregate before the shuffle and a final one after it: a hot group
(one place or one region holding a third of the rows) is pre-reduced inside
each map task and only one row per group per task crosses the network.
Global aggregates shuffle a single partial row per task. Averages come from
sums that are the same in any order (:mod:`tremor.functions.exact`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.config import ALERT_STEPS, DEFAULT_REGION, TOP_PLACES_N
from tremor.functions.classify import mag_range
from tremor.functions.exact import add_parts, exact_avg, exact_sum_parts, parts_to_double
from tremor.functions.numeric import nan_to_null, round_like_python
from tremor.operators.regions import filter_region


def _mag() -> Column:
    return nan_to_null(F.col("mag"))


def catalog_count(df: DataFrame) -> DataFrame:
    """One row: ``count``."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def _counts_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def _most_frequent_first(name: str):
    return [F.col("count").desc(), F.col(name).asc_nulls_first()]


def mag_range_counts(df: DataFrame, null_label: str | None = None, sort: bool = True) -> DataFrame:
    """``mag_range, count``, most frequent first.

    The table has at most one row per range label (six with ``null_label``),
    so it is sorted inside one task; a global sort would add a range-sampling
    job to order five rows.
    """
    counts = _counts_by(df, mag_range(_mag(), null_label=null_label), "mag_range")
    return counts.coalesce(1).sortWithinPartitions(*_most_frequent_first("mag_range")) if sort else counts


def region_counts(df: DataFrame, sort: bool = True) -> DataFrame:
    """``region, count``, most frequent first. ``region`` is data (any number of
    values in a foreign catalog), so the sort stays distributed."""
    counts = _counts_by(df, F.col("region"), "region")
    return counts.orderBy(*_most_frequent_first("region")) if sort else counts


def top_places(df: DataFrame, n: int = TOP_PLACES_N) -> DataFrame:
    """The ``n`` places with most events (a missing place is its own group).

    Ties are broken by place text so the cut is deterministic; the plan is a
    partial/final count followed by a top-k (``TakeOrderedAndProject``), so
    only ``n`` rows per task reach the final merge.
    """
    return _counts_by(df, F.col("place"), "place").orderBy(*_most_frequent_first("place")).limit(n)


def regional_stats(df: DataFrame, name: str = DEFAULT_REGION.name) -> DataFrame:
    """One row for the region: ``total, avg_mag, max_mag, min_mag`` (a row even when empty)."""
    m = _mag()
    return filter_region(df, name).agg(
        F.count(F.lit(1)).alias("total"),
        exact_avg(m).alias("avg_mag"),
        F.max(m).alias("max_mag"),
        F.min(m).alias("min_mag"),
    )


def regional_avg_mag(df: DataFrame, name: str = DEFAULT_REGION.name) -> DataFrame:
    """One row: ``avg_mag`` of the region."""
    return filter_region(df, name).agg(exact_avg(_mag()).alias("avg_mag"))


def summary(df: DataFrame, name: str = DEFAULT_REGION.name, digits: int = 2,
            steps: Sequence[tuple[float, str]] = ALERT_STEPS) -> DataFrame:
    """Dashboard summary in one scan: total, regional count, alert counts
    (above the top alert threshold; above the second and up to the top), and
    the average and maximum magnitude rounded to ``digits`` exactly as
    Python's ``round`` does (0.0 when no magnitude is known)."""
    m = _mag()
    (top, _), (second, _) = steps[0], steps[1]
    return df.agg(
        F.count(F.lit(1)).alias("total_earthquakes"),
        F.count_if(F.col("region") == F.lit(name)).alias(f"{name.lower()}_count"),
        F.count_if(m > F.lit(top)).alias("critical_count"),
        F.count_if((m > F.lit(second)) & (m <= F.lit(top))).alias("high_count"),
        F.coalesce(round_like_python(exact_avg(m), digits), F.lit(0.0)).alias("average_magnitude"),
        F.coalesce(round_like_python(F.max(m), digits), F.lit(0.0)).alias("max_magnitude"),
    )


def sum_columns(parts: dict[str, Column], name: str = "mag") -> list[Column]:
    """The parts of an exact sum as columns of a table of states."""
    return [part.alias(f"{name}_{key}") for key, part in parts.items()]


def added_sum(name: str = "mag") -> Column:
    """Aggregate: the sum of all rows' states as a double."""
    return parts_to_double(**add_parts(*(F.col(f"{name}_{key}") for key in ("high", "low", "other"))))


# -- one-pass profile for jobs that need several of the tables above ----------

def range_region_profile(df: DataFrame, null_label: str | None = None) -> DataFrame:
    """Per ``(mag_range, region)``: ``n`` rows, ``n_mag`` known magnitudes, the
    parts of their exact sum (``mag_high, mag_low, mag_other``), ``max_mag``,
    ``min_mag``.

    One scan of ``mag`` and ``region`` and a partial/final aggregate whose
    result has at most one row per (range label, region). The row count, the
    range and region counts and the regional statistics all follow from it
    (:func:`profile_tables`), so a job needing all four reads the catalog once.
    """
    m = _mag()
    return df.groupBy(mag_range(m, null_label=null_label).alias("mag_range"), F.col("region")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(m).alias("n_mag"),
        *sum_columns(exact_sum_parts(m)),
        F.max(m).alias("max_mag"),
        F.min(m).alias("min_mag"),
    )


def profile_tables(profile: DataFrame, name: str = DEFAULT_REGION.name) -> dict[str, DataFrame]:
    """``catalog_count``, ``mag_range_counts``, ``region_counts`` and
    ``regional_stats`` (same columns as the direct operators) from a
    :func:`range_region_profile`."""
    ranges = profile.groupBy("mag_range").agg(F.sum("n").alias("count"))
    regions = profile.groupBy("region").agg(F.sum("n").alias("count"))
    regional = filter_region(profile, name)
    return {
        "catalog_count": profile.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("count")),
        "mag_range_counts": ranges.coalesce(1).sortWithinPartitions(*_most_frequent_first("mag_range")),
        "region_counts": regions.orderBy(*_most_frequent_first("region")),
        "regional_stats": regional.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
            F.try_divide(added_sum(), F.sum("n_mag").cast("double")).alias("avg_mag"),
            F.max("max_mag").alias("max_mag"),
            F.min("min_mag").alias("min_mag"),
        ),
    }
