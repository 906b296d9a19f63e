"""Serving views: event records with alert level, regional and recent events.

Records are a projection (no shuffle). ``recent_events`` is a top-k, so each
task keeps only ``n`` rows; ``regional_events`` is a full distributed sort
whose order keys include tie-breakers, which also spreads a run of equal
times over several range partitions instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import DEFAULT_REGION, RECENT_EVENTS_N, RECORD_COLUMNS
from tremor.functions.classify import alert_level
from tremor.functions.time import iso_utc
from tremor.operators.regions import filter_region

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("depth", T.DoubleType()),
        T.StructField("mag", T.DoubleType()),
        T.StructField("place", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("alert_level", T.StringType()),
    ]
)


def event_records(df: DataFrame) -> DataFrame:
    """The API record: ISO-8601 UTC time, coordinates, depth, magnitude,
    place, region and alert level."""
    return df.select(
        iso_utc(F.col("time")).alias("time"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("depth"),
        F.col("mag"),
        F.col("place").cast("string").alias("place"),
        F.col("region").cast("string").alias("region"),
        alert_level(F.col("mag")).alias("alert_level"),
    )


def event_json(df: DataFrame) -> DataFrame:
    """One JSON object per event (``json`` column); null fields are written as null."""
    records = event_records(df)
    return records.select(
        F.to_json(F.struct(*RECORD_COLUMNS), {"ignoreNullFields": "false"}).alias("json")
    )


def parse_event_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Inverse of :func:`event_json`: JSON text back to record columns."""
    return df.select(F.from_json(F.col(column), RECORD_SCHEMA).alias("_r")).select("_r.*")


def _newest_first():
    return [
        F.col("time").desc_nulls_last(),
        F.col("latitude").asc_nulls_first(),
        F.col("longitude").asc_nulls_first(),
        F.col("depth").asc_nulls_first(),
        F.col("mag").asc_nulls_first(),
        F.col("place").asc_nulls_first(),
    ]


def regional_events(df: DataFrame, name: str = DEFAULT_REGION.name) -> DataFrame:
    """Records of one region, newest first (missing times last).

    A full sort: range partitioning sends equal sort keys to one task, so a
    run of rows equal on every key (say a third of the catalog with no time and
    the same coordinates) would land in one task. Such rows give identical
    records, so their relative order is free; a row-position id as the last
    key lets the range partitioner split the run across tasks.
    """
    spread = F.monotonically_increasing_id()
    return event_records(filter_region(df, name).orderBy(*_newest_first(), spread))


def recent_events(df: DataFrame, n: int = RECENT_EVENTS_N) -> DataFrame:
    """The ``n`` newest records (missing times last)."""
    return event_records(df.orderBy(*_newest_first()).limit(n))
