"""Live alerting over a stream of event lines.

Source → :func:`decode_lines` → :func:`classify_alerts` → two sinks:

* watch: HIGH and top-level alerts, six columns, to the console (or to Parquet
  when a path is given, which is what tests use);
* archive: top-level alerts only, to Parquet with a checkpoint — the file sink
  plus a replayable source gives exactly-once output across restarts.

Both queries are stateless (filter/project), so there is no watermark or state
store to size; each keeps its own checkpoint and reads the source on its own.
The default source is a directory of line files (replayable, bounded per
micro-batch by ``maxFilesPerTrigger``); Kafka and socket readers are offered
for deployments that have them.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.config import ALERT_STEPS, ARCHIVE_COLUMNS, DEFAULT_REGION, STREAM_CRITICAL_LABEL, WATCH_COLUMNS
from tremor.functions.classify import region_flag, stream_alert_level
from tremor.sources.lines import decode_lines, reject_reason, rejected_lines


def flag_column(region_name: str = DEFAULT_REGION.name) -> str:
    return f"is_{region_name.lower()}"


#: Longer than any file is old: no line file is too late to be read.
NO_AGE_LIMIT = "36500d"


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                max_file_age: str = NO_AGE_LIMIT) -> DataFrame:
    """Streaming frame with one ``value`` column, read from line files under ``path``.

    Spark's file source skips files older than ``maxFileAge`` before the newest
    one (its default is a week), which would lose alerts of files that arrive
    late with their old modification time. By default no file is skipped; the
    cost is that the source remembers every file it has read. A shorter
    ``max_file_age`` bounds that memory where late files cannot happen.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def kafka_line_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **options: str) -> DataFrame:
    """Lines from a Kafka topic (needs the Kafka connector on the classpath)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def socket_line_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. Not replayable: no exactly-once guarantee."""
    return spark.readStream.format("socket").option("host", host).option("port", int(port)).load()


def classify_alerts(
    df: DataFrame,
    region_name: str = DEFAULT_REGION.name,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    top_label: str = STREAM_CRITICAL_LABEL,
) -> DataFrame:
    """Add ``alert_level`` (top step relabelled ``top_label``) and the region flag."""
    return df.withColumns(
        {
            "alert_level": stream_alert_level(F.col("mag"), steps, top_label=top_label),
            flag_column(region_name): region_flag(F.col("region"), region_name),
        }
    )


def alerts_from_lines(
    lines: DataFrame,
    region_name: str = DEFAULT_REGION.name,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    top_label: str = STREAM_CRITICAL_LABEL,
) -> DataFrame:
    """Decode then classify (batch or streaming)."""
    return classify_alerts(decode_lines(lines), region_name, steps, top_label)


def _above(threshold: float):
    """``mag > threshold`` for a known (non-NaN) magnitude: the row test behind
    a ladder label. Filtering on it rather than on the label text keeps the
    predicate a plain comparison; a label test reaches the source as a
    ``CASE`` over the whole ladder."""
    mag = F.col("mag")
    return (mag > F.lit(threshold)) & ~F.isnan(mag)


def _watch_columns(region_name: str) -> list[str]:
    return [*WATCH_COLUMNS, flag_column(region_name), "time_raw"]


def watch_alerts(
    alerts: DataFrame,
    region_name: str = DEFAULT_REGION.name,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
) -> DataFrame:
    """HIGH and top-level alerts: ``time, place, mag, depth, alert_level,
    is_<region>``, and the raw time text, which is all there is for a bad clock.

    ``alerts`` comes from :func:`classify_alerts` with the same ``steps``; the
    two top labels are exactly the rows above the second threshold.
    """
    return alerts.filter(_above(steps[1][0])).select(*_watch_columns(region_name))


def critical_alerts(
    alerts: DataFrame,
    region_name: str = DEFAULT_REGION.name,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
) -> DataFrame:
    """Top-level alerts with every catalog field, the region flag and the raw
    time text (the rows above the top threshold of ``steps``)."""
    return alerts.filter(_above(steps[0][0])).select(*ARCHIVE_COLUMNS, flag_column(region_name), "time_raw")


def _with_trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def print_rows(df: DataFrame, rows: int) -> None:
    """Print the first ``rows`` rows and say how many were left out."""
    df.show(rows, truncate=False)
    left = df.count() - rows
    if left > 0:
        print(f"... and {left} more rows")


def start_alert_queries(
    alerts: DataFrame,
    archive_path: str,
    checkpoint_root: str,
    watch_path: str | None = None,
    trigger: dict | None = None,
    region_name: str = DEFAULT_REGION.name,
    name_prefix: str | None = None,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    console_rows: int = 20,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the watch and archive queries; returns ``(watch, archive)``.

    ``steps`` is the ladder that ``alerts`` was classified with. ``trigger`` is
    passed to ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}`` for
    a bounded catch-up run, or ``{"processingTime": "5 seconds"}``). Each query
    has its own checkpoint. Without a ``watch_path`` the watch rows are printed,
    ``console_rows`` of each micro-batch and the number of the others. If the
    second query does not start, the first is stopped.
    """
    watch_df = watch_alerts(alerts, region_name, steps)
    archive_df = critical_alerts(alerts, region_name, steps)

    watch = watch_df.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint_root}/watch")
    if watch_path is None:
        def show(batch: DataFrame, batch_id: int) -> None:
            kept = batch.persist()
            try:
                print(f"batch {batch_id}")
                print_rows(kept, console_rows)
            finally:
                kept.unpersist()

        watch = watch.foreachBatch(show)
    else:
        watch = watch.format("parquet").option("path", watch_path)
    archive = (
        archive_df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", archive_path)
        .option("checkpointLocation", f"{checkpoint_root}/archive")
    )
    if name_prefix:
        watch = watch.queryName(f"{name_prefix}_watch")
        archive = archive.queryName(f"{name_prefix}_archive")
    first = _with_trigger(watch, trigger).start()
    try:
        return first, _with_trigger(archive, trigger).start()
    except Exception:
        first.stop()
        raise


#: Name of the counts in a reject query's progress (``observedMetrics``).
LINE_COUNTS = "line_counts"


def start_reject_query(lines: DataFrame, rejects_path: str, checkpoint_path: str, trigger: dict | None = None,
                       name: str | None = None) -> StreamingQuery:
    """Write the lines that decode to nothing, with their reasons, to Parquet:
    the side output of the alert queries, exactly once like the archive. Each
    progress report of the query counts its ``lines`` and the ``rejected``."""
    counted = lines.observe(LINE_COUNTS, F.count(F.lit(1)).alias("lines"),
                            F.count_if(reject_reason().isNotNull()).alias("rejected"))
    writer = (rejected_lines(counted).writeStream.outputMode("append").format("parquet").option("path", rejects_path)
              .option("checkpointLocation", checkpoint_path))
    return _with_trigger(writer.queryName(name) if name else writer, trigger).start()


#: Seconds between two looks at running queries.
_POLL_SECONDS = 0.2


def _stop_all(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()


def _raise_failure(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        if not q.isActive and q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")


def await_any(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Block until one of ``queries`` ends (or ``timeout`` seconds, if given),
    then stop them all; a failure is raised. Other queries of the session play
    no part."""
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while all(q.isActive for q in queries) and (end is None or time.monotonic() < end):
            time.sleep(_POLL_SECONDS)
        _raise_failure(queries)
    finally:
        _stop_all(queries)


def run_bounded(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for all ``availableNow`` queries to drain their input.

    There is no time limit unless ``timeout`` (seconds) is given. The first
    failure is raised at once, whichever query it is; then, as on expiry, all
    queries are stopped.
    """
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while any(q.isActive for q in queries):
            _raise_failure(queries)
            if end is not None and time.monotonic() >= end:
                raise TimeoutError(f"streaming queries did not finish in {timeout}s")
            time.sleep(_POLL_SECONDS)
        _raise_failure(queries)
    finally:
        _stop_all(queries)


def start_fused_alert_query(
    alerts: DataFrame,
    archive_path: str,
    checkpoint_path: str,
    watch_path: str | None = None,
    trigger: dict | None = None,
    region_name: str = DEFAULT_REGION.name,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    console_rows: int = 20,
) -> StreamingQuery:
    """One query that feeds both outputs from a single read of the source.

    Each micro-batch keeps only the alert rows either output needs (HIGH and
    above), persists that slice, and writes the archive and watch tables into
    a folder per batch id with ``overwrite``. A batch replayed after a failure
    rewrites its own folders, so output stays exactly-once without a second
    source read. With ``watch_path=None`` the watch rows are printed instead,
    ``console_rows`` of each micro-batch and the number of the others.
    """
    def write_both(batch: DataFrame, batch_id: int) -> None:
        kept = batch.filter(_above(steps[1][0])).persist()
        try:
            archive = critical_alerts(kept, region_name, steps)
            archive.write.mode("overwrite").parquet(f"{archive_path}/batch_id={batch_id}")
            watch = kept.select(*_watch_columns(region_name))
            if watch_path is None:
                print_rows(watch, console_rows)
            else:
                watch.write.mode("overwrite").parquet(f"{watch_path}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    writer = alerts.writeStream.foreachBatch(write_both).option("checkpointLocation", checkpoint_path)
    return _with_trigger(writer, trigger).start()
