"""Sinks: result tables, partitioned catalog, event-line files."""

from tremor.sinks.refresh import refresh_catalog
from tremor.sinks.writers import read_result, write_catalog, write_lines, write_result

__all__ = ["read_result", "refresh_catalog", "write_catalog", "write_lines", "write_result"]
