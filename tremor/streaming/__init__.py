"""Structured Streaming alert queries."""

from tremor.streaming.alerts import (
    NO_AGE_LIMIT,
    alerts_from_lines,
    await_any,
    classify_alerts,
    critical_alerts,
    flag_column,
    kafka_line_stream,
    line_stream,
    run_bounded,
    socket_line_stream,
    start_alert_queries,
    start_fused_alert_query,
    start_reject_query,
    watch_alerts,
)

__all__ = [
    "NO_AGE_LIMIT",
    "alerts_from_lines",
    "await_any",
    "classify_alerts",
    "critical_alerts",
    "flag_column",
    "kafka_line_stream",
    "line_stream",
    "run_bounded",
    "socket_line_stream",
    "start_alert_queries",
    "start_fused_alert_query",
    "start_reject_query",
    "watch_alerts",
]
