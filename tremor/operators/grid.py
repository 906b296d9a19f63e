"""Grid-cell hotspots.

Two policies exist and both are kept: the distributed hotspot job rounds
half-up and keeps missing coordinates as their own cell; the top-cells view
drops rows with a missing coordinate and rounds half-even.

For valid coordinates the number of cells is bounded by the grid (1,801 ×
3,601 ≈ 6.5 million at 0.1°, plus cells for missing coordinates), not by the
data, so sorting the cell table stays cheap however large the catalog grows;
the count itself is a partial/final aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.config import DEFAULT_REGION, GRID_DIGITS, HOTSPOTS_TOP_N
from tremor.functions.classify import risk_level
from tremor.functions.numeric import grid_snap
from tremor.operators.regions import filter_region


def with_grid(df: DataFrame, digits: int = GRID_DIGITS, mode: str = "half_up") -> DataFrame:
    """Add ``lat_grid`` and ``lon_grid``."""
    return df.withColumns(
        {
            "lat_grid": grid_snap(F.col("latitude"), digits, mode),
            "lon_grid": grid_snap(F.col("longitude"), digits, mode),
        }
    )


def _cell_order():
    return [F.col("count").desc(), F.col("lat_grid").asc_nulls_first(), F.col("lon_grid").asc_nulls_first()]


def cell_counts(df: DataFrame, digits: int = GRID_DIGITS, mode: str = "half_up") -> DataFrame:
    """``lat_grid, lon_grid, count`` for every occupied cell."""
    return (
        df.select(
            grid_snap(F.col("latitude"), digits, mode).alias("lat_grid"),
            grid_snap(F.col("longitude"), digits, mode).alias("lon_grid"),
        )
        .groupBy("lat_grid", "lon_grid")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def hotspots(
    df: DataFrame,
    region: str | None = None,
    digits: int = GRID_DIGITS,
    mode: str = "half_up",
    sort: bool = True,
) -> DataFrame:
    """``lat_grid, lon_grid, count, risk_level``; optional region filter
    (falsy → all rows). Sorted by count descending unless ``sort=False``
    (skip the sort before a file write)."""
    cells = cell_counts(filter_region(df, region), digits, mode)
    out = cells.withColumn("risk_level", risk_level(F.col("count")))
    return out.orderBy(*_cell_order()) if sort else out


def hotspots_preview(df: DataFrame, n: int, region: str | None = None) -> DataFrame:
    """First ``n`` rows of :func:`hotspots` (a top-k, not a full sort)."""
    return hotspots(df, region).limit(n)


def hotspots_top(df: DataFrame, n: int = HOTSPOTS_TOP_N, digits: int = GRID_DIGITS) -> DataFrame:
    """Top ``n`` cells as ``latitude, longitude, count``: rows with a missing
    coordinate dropped, half-even grid, no risk level."""
    located = df.dropna(subset=["latitude", "longitude"])
    top = cell_counts(located, digits, mode="half_even").orderBy(*_cell_order()).limit(n)
    return top.select(
        F.col("lat_grid").alias("latitude"), F.col("lon_grid").alias("longitude"), F.col("count")
    )


def cell_profile(
    df: DataFrame, region: str = DEFAULT_REGION.name, digits: int = GRID_DIGITS, mode: str = "half_up"
) -> DataFrame:
    """``lat_grid, lon_grid, count, regional_count`` in one scan: the global
    and the regional hotspot tables of the hotspot job from one aggregate."""
    return (
        df.select(
            grid_snap(F.col("latitude"), digits, mode).alias("lat_grid"),
            grid_snap(F.col("longitude"), digits, mode).alias("lon_grid"),
            F.col("region"),
        )
        .groupBy("lat_grid", "lon_grid")
        .agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("region") == F.lit(region)).alias("regional_count"))
    )


def profile_hotspots(profile: DataFrame, regional: bool = False) -> DataFrame:
    """Unsorted :func:`hotspots` table (global, or regional) from a :func:`cell_profile`."""
    count = F.col("regional_count") if regional else F.col("count")
    cells = profile.filter(count > 0) if regional else profile
    return cells.select("lat_grid", "lon_grid", count.alias("count"), risk_level(count).alias("risk_level"))
