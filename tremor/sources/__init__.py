"""Scans: catalog (Parquet/CSV), landed feeds, comma-separated event lines."""

from tremor.sources.catalog import normalize, read_catalog
from tremor.sources.feeds import (
    EmptyFeedError,
    feed_slice,
    read_feed,
    require_non_empty,
    trailing_range,
    trailing_window,
)
from tremor.sources.lines import decode_lines, encode_lines, reject_counts, rejected_lines

__all__ = [
    "EmptyFeedError",
    "decode_lines",
    "encode_lines",
    "feed_slice",
    "normalize",
    "read_catalog",
    "read_feed",
    "reject_counts",
    "rejected_lines",
    "require_non_empty",
    "trailing_range",
    "trailing_window",
]
