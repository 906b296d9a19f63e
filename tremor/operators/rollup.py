"""Daily states: mergeable partial aggregates of a catalog laid out by date.

One row per day, region, magnitude range and grid cell holds counts, extremes
and the parts of an exact sum. Every count and average of the dashboard follows
from adding rows, so a view reads the states instead of the catalog, and after a
refresh only the states of the touched days are made anew.

A state row stands for at least one event, so the states are never larger than
the catalog, and their number is bounded by the days times the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import ALERT_STEPS, DEFAULT_REGION, GRID_DIGITS, HOTSPOTS_TOP_N, TOP_PLACES_N
from tremor.functions.classify import mag_range, risk_level
from tremor.functions.exact import exact_sum_parts
from tremor.functions.numeric import grid_snap, nan_to_null, round_like_python
from tremor.operators.analytics import added_sum, sum_columns
from tremor.operators.regions import filter_region
from tremor.sinks.refresh import on_days, touched_days
from tremor.sinks.writers import DATE_COLUMN

CELLS, PLACES = "cells", "places"


def cell_states(catalog: DataFrame, digits: int = GRID_DIGITS, steps: Sequence[tuple[float, str]] = ALERT_STEPS) -> DataFrame:
    """Per ``event_date, region, mag_range`` and cell (by both roundings of the
    grid): ``n, n_mag, mag_high, mag_low, mag_other, max_mag, min_mag, critical,
    high``."""
    m = nan_to_null(F.col("mag"))
    (top, _), (second, _) = steps[0], steps[1]
    cells = {f"{axis}_{mode}": grid_snap(F.col(column), digits, mode) for axis, column in (("lat", "latitude"), ("lon", "longitude"))
             for mode in ("half_up", "half_even")}
    keyed = catalog.select(F.to_date("time").alias(DATE_COLUMN), "region", mag_range(m).alias("mag_range"),
                           *(c.alias(k) for k, c in cells.items()), m.alias("m"))
    return keyed.groupBy(DATE_COLUMN, "region", "mag_range", *cells).agg(
        F.count(F.lit(1)).alias("n"), F.count("m").alias("n_mag"), *sum_columns(exact_sum_parts(F.col("m"))),
        F.max("m").alias("max_mag"), F.min("m").alias("min_mag"), F.count_if(F.col("m") > top).alias("critical"),
        F.count_if((F.col("m") > second) & (F.col("m") <= top)).alias("high"))


def place_states(catalog: DataFrame) -> DataFrame:
    """Per ``event_date, place``: ``n`` events."""
    return catalog.groupBy(F.to_date("time").alias(DATE_COLUMN), "place").agg(F.count(F.lit(1)).alias("n"))


def write_states(spark: SparkSession, catalog_path: str, states_path: str, days: Sequence | None = None) -> None:
    """Write the states of a catalog laid out by date under ``states_path``: of
    all days, or only of ``days``, whose folders are replaced. Days never lose
    their last event in a refresh, so no folder is left over."""
    catalog = spark.read.parquet(catalog_path)
    if days is not None:
        if not days:
            return
        catalog = catalog.where(on_days(days))
    for name, states in ((CELLS, cell_states(catalog)), (PLACES, place_states(catalog))):
        writer = states.hint("rebalance", DATE_COLUMN).write.mode("overwrite").partitionBy(DATE_COLUMN)
        if days is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(f"{states_path}/{name}")


def refresh_states(spark: SparkSession, catalog_path: str, states_path: str, feeds: Sequence[DataFrame]) -> None:
    """Make the states of the days that ``feeds`` touched anew, after
    :func:`tremor.sinks.refresh_catalog` merged them into the catalog."""
    write_states(spark, catalog_path, states_path, touched_days(feeds))


def read_states(spark: SparkSession, states_path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{states_path}/{name}") for name in (CELLS, PLACES)}


# -- the tables that follow from the states ------------------------------------------

def _long(c):
    return F.coalesce(c, F.lit(0)).cast("bigint")


def summary(cells: DataFrame, name: str = DEFAULT_REGION.name, digits: int = 2) -> DataFrame:
    """:func:`tremor.operators.analytics.summary` from the cell states."""
    average = F.try_divide(added_sum(), F.sum("n_mag").cast("double"))
    return cells.agg(
        _long(F.sum("n")).alias("total_earthquakes"),
        _long(F.sum(F.when(F.col("region") == name, F.col("n")))).alias(f"{name.lower()}_count"),
        _long(F.sum("critical")).alias("critical_count"), _long(F.sum("high")).alias("high_count"),
        F.coalesce(round_like_python(average, digits), F.lit(0.0)).alias("average_magnitude"),
        F.coalesce(round_like_python(F.max("max_mag"), digits), F.lit(0.0)).alias("max_magnitude"))


def regional_stats(cells: DataFrame, name: str = DEFAULT_REGION.name) -> DataFrame:
    """:func:`tremor.operators.analytics.regional_stats` from the cell states."""
    return filter_region(cells, name).agg(
        _long(F.sum("n")).alias("total"), F.try_divide(added_sum(), F.sum("n_mag").cast("double")).alias("avg_mag"),
        F.max("max_mag").alias("max_mag"), F.min("min_mag").alias("min_mag"))


def counts_by(states: DataFrame, key: str) -> DataFrame:
    """``key, count``, most frequent first: magnitude ranges or regions (of the
    cell states), places (of the place states)."""
    return states.groupBy(key).agg(F.sum("n").alias("count")).orderBy(F.col("count").desc(), F.col(key).asc_nulls_first())


def top_places(places: DataFrame, n: int = TOP_PLACES_N) -> DataFrame:
    """:func:`tremor.operators.analytics.top_places` from the place states."""
    return counts_by(places, "place").limit(n)


def _cell_counts(cells: DataFrame, mode: str) -> DataFrame:
    return cells.groupBy(F.col(f"lat_{mode}").alias("lat_grid"), F.col(f"lon_{mode}").alias("lon_grid")).agg(F.sum("n").alias("count"))


def hotspots(cells: DataFrame, region: str | None = None) -> DataFrame:
    """:func:`tremor.operators.grid.hotspots`, unsorted, from the cell states."""
    return _cell_counts(filter_region(cells, region), "half_up").withColumn("risk_level", risk_level(F.col("count")))


def hotspots_top(cells: DataFrame, n: int = HOTSPOTS_TOP_N) -> DataFrame:
    """:func:`tremor.operators.grid.hotspots_top` from the cell states."""
    located = cells.dropna(subset=["lat_half_even", "lon_half_even"])
    top = _cell_counts(located, "half_even").orderBy(F.col("count").desc(), F.col("lat_grid"), F.col("lon_grid")).limit(n)
    return top.select(F.col("lat_grid").alias("latitude"), F.col("lon_grid").alias("longitude"), "count")
