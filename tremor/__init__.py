"""tremor — seismic catalog analytics on Spark.

Merge overlapping event feeds into one deduplicated, region-tagged catalog;
compute magnitude distributions, regional statistics, most-affected places and
grid-cell hotspots; serve summary, regional and recent-event views; classify a
stream of event lines into alerts. Everything is built from Spark SQL
expressions and Structured Streaming; batch and stream share the same
functions.
"""

from tremor.config import CATALOG_SCHEMA, DEFAULT_REGION, Region
from tremor.operators import (
    assign_region,
    catalog_count,
    dedupe_keep_first,
    event_json,
    event_records,
    filter_region,
    hotspots,
    hotspots_preview,
    hotspots_top,
    mag_range_counts,
    merge_feeds,
    merge_report,
    recent_events,
    region_counts,
    regional_avg_mag,
    regional_events,
    regional_stats,
    summary,
    top_places,
    union_feeds,
)
from tremor.session import build_session, sizing_conf
from tremor.sinks import write_catalog, write_lines, write_result
from tremor.sources import decode_lines, encode_lines, feed_slice, normalize, read_catalog, read_feed
from tremor.streaming import alerts_from_lines, line_stream, start_alert_queries, start_fused_alert_query

__version__ = "0.1.0"

__all__ = [
    "CATALOG_SCHEMA",
    "DEFAULT_REGION",
    "Region",
    "alerts_from_lines",
    "assign_region",
    "build_session",
    "catalog_count",
    "decode_lines",
    "dedupe_keep_first",
    "encode_lines",
    "event_json",
    "event_records",
    "feed_slice",
    "filter_region",
    "hotspots",
    "hotspots_preview",
    "hotspots_top",
    "line_stream",
    "mag_range_counts",
    "merge_feeds",
    "merge_report",
    "normalize",
    "read_catalog",
    "read_feed",
    "recent_events",
    "region_counts",
    "regional_avg_mag",
    "regional_events",
    "regional_stats",
    "sizing_conf",
    "start_alert_queries",
    "start_fused_alert_query",
    "summary",
    "top_places",
    "union_feeds",
    "write_catalog",
    "write_lines",
    "write_result",
]
