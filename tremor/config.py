"""Catalog schema, the regional box and every threshold/label the library uses.

Operators take these as defaults; every one of them can be overridden by
argument, so nothing below is hard-wired into an operator body.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's values for results to match;
# they are stated here once, in natural order, and nowhere else.
# ---------------------------------------------------------------------------

# Catalog columns, in order.
CATALOG_COLUMNS = ("time", "latitude", "longitude", "depth", "mag", "place", "type", "region")

# Regional bounding box (closed on all four sides) and the two region labels.
REGION_NAME = "Pakistan"
REGION_MIN_LAT = 23.0
REGION_MAX_LAT = 37.0
REGION_MIN_LON = 60.0
REGION_MAX_LON = 77.0
OTHER_REGION = "Global"

# Magnitude ranges: < 2 Minor, [2, 4) Light, [4, 6) Moderate, [6, 8] Strong,
# anything else (above 8, and a missing magnitude) Major.
MAG_RANGE_LABELS = ("Minor", "Light", "Moderate", "Strong", "Major")
MAG_RANGE_BOUNDS = (2.0, 4.0, 6.0, 8.0)

# Alert level on magnitude, strictly greater than: 6 CRITICAL, 5 HIGH, 4 MEDIUM, else LOW.
ALERT_STEPS = ((6.0, "CRITICAL"), (5.0, "HIGH"), (4.0, "MEDIUM"))
ALERT_DEFAULT = "LOW"
# The stream path relabels the top level.
STREAM_CRITICAL_LABEL = "CRITICAL !!"

# Risk level on grid-cell count, strictly greater than: 50 CRITICAL, 30 HIGH, 10 MEDIUM, else LOW.
RISK_STEPS = ((50, "CRITICAL"), (30, "HIGH"), (10, "MEDIUM"))
RISK_DEFAULT = "LOW"

# Grid cell size: coordinates rounded to one decimal.
GRID_DIGITS = 1

# Report sizes.
TOP_PLACES_N = 10
HOTSPOTS_TOP_N = 20
HOTSPOTS_PREVIEW_N = 10
HOTSPOTS_REGIONAL_PREVIEW_N = 5
RECENT_EVENTS_N = 100

# Feed requests: trailing window length and minimum magnitudes.
FEED_DAYS = 30
GLOBAL_FEED_MIN_MAG = 2.5
REGIONAL_FEED_MIN_MAG = 2.0

# Keep-first dedupe key of the feed merge.
DEDUPE_KEYS = ("time", "mag")

# Stream line codec: field separator, and characters blanked inside a field.
LINE_SEPARATOR = ","
LINE_BLANKED_CHARS = "\n\r,"

# Output columns: the API event record; the watch alert (plus the region flag);
# the archived critical alert (plus the region flag).
RECORD_COLUMNS = ("time", "latitude", "longitude", "depth", "mag", "place", "region", "alert_level")
WATCH_COLUMNS = ("time", "place", "mag", "depth", "alert_level")
ARCHIVE_COLUMNS = ("time", "latitude", "longitude", "depth", "mag", "place", "type", "region", "alert_level")

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Region:
    """A named, closed latitude/longitude box."""

    name: str
    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float


DEFAULT_REGION = Region(REGION_NAME, REGION_MIN_LAT, REGION_MAX_LAT, REGION_MIN_LON, REGION_MAX_LON)

# Catalog at rest. ``time`` holds the UTC wall clock without a zone, so values do
# not move with ``spark.sql.session.timeZone`` and map 1:1 onto Parquet/SQL TIMESTAMP.
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("depth", T.DoubleType(), True),
        T.StructField("mag", T.DoubleType(), True),
        T.StructField("place", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
    ]
)

# A raw feed carries the same columns without ``region`` (it is derived).
FEED_SCHEMA = T.StructType([f for f in CATALOG_SCHEMA.fields if f.name != "region"])
