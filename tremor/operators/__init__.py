"""DataFrame → DataFrame operators. All are lazy; none collects or shows."""

from tremor.operators.analytics import (
    catalog_count,
    mag_range_counts,
    region_counts,
    regional_avg_mag,
    regional_stats,
    summary,
    top_places,
)
from tremor.operators.grid import (
    cell_counts,
    cell_profile,
    hotspots,
    hotspots_preview,
    hotspots_top,
    profile_hotspots,
    with_grid,
)
from tremor.operators.merge import (
    dedupe_full_row,
    dedupe_keep_first,
    merge_feeds,
    merge_report,
    union_feeds,
)
from tremor.operators.regions import MissingColumnsError, assign_region, filter_region, require_columns
from tremor.operators.views import event_json, event_records, parse_event_json, recent_events, regional_events

__all__ = [
    "MissingColumnsError",
    "assign_region",
    "catalog_count",
    "cell_counts",
    "dedupe_full_row",
    "dedupe_keep_first",
    "event_json",
    "event_records",
    "filter_region",
    "hotspots",
    "hotspots_preview",
    "hotspots_top",
    "mag_range_counts",
    "parse_event_json",
    "merge_feeds",
    "merge_report",
    "recent_events",
    "region_counts",
    "regional_avg_mag",
    "regional_stats",
    "require_columns",
    "summary",
    "top_places",
    "union_feeds",
    "with_grid",
]
