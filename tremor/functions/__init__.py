"""Column expressions shared by batch and streaming operators."""

from tremor.functions.classify import (
    alert_level,
    in_region,
    mag_range,
    region_flag,
    region_label,
    risk_level,
    stream_alert_level,
)
from tremor.functions.ladder import ladder
from tremor.functions.numeric import grid_snap, nan_to_null, round_half_even, round_like_python, to_double
from tremor.functions.time import iso_utc, line_time_text, parse_utc_time, to_utc_time, utc_wallclock

__all__ = [
    "alert_level",
    "grid_snap",
    "in_region",
    "iso_utc",
    "ladder",
    "line_time_text",
    "mag_range",
    "nan_to_null",
    "parse_utc_time",
    "region_flag",
    "region_label",
    "risk_level",
    "round_half_even",
    "round_like_python",
    "stream_alert_level",
    "to_double",
    "to_utc_time",
    "utc_wallclock",
]
