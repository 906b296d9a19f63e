"""No alert is lost to age or time limits, and failures surface at once."""

from __future__ import annotations

import os
import time

import pytest
from tremor.operators.analytics import summary
from tremor.streaming import alerts_from_lines, await_any, line_stream, run_bounded, start_alert_queries, start_fused_alert_query

LINE = "2024-01-0{d}T00:00:00Z,30,70,10,{mag},P,q,Pakistan\n"


def land(folder, name, text, age_days=0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    then = time.time() - age_days * 86400
    os.utime(path, (then, then))


def run(spark, tmp_dir, **how):
    alerts = alerts_from_lines(line_stream(spark, f"{tmp_dir}/in"), **{k: how[k] for k in ("steps",) if k in how})
    run_bounded(start_alert_queries(alerts, f"{tmp_dir}/archive", f"{tmp_dir}/cp", f"{tmp_dir}/watch",
                                    {"availableNow": True}, **how))


def test_a_late_file_of_old_date_is_read(spark, tmp_dir):
    land(f"{tmp_dir}/in", "a.txt", LINE.format(d=1, mag=7.0))
    run(spark, tmp_dir)
    land(f"{tmp_dir}/in", "b.txt", LINE.format(d=2, mag=7.5), age_days=10)
    run(spark, tmp_dir)
    assert sorted(r.mag for r in spark.read.parquet(f"{tmp_dir}/archive").collect()) == [7.0, 7.5]
    assert spark.read.parquet(f"{tmp_dir}/watch").count() == 2


def test_a_watch_alert_keeps_its_raw_time(spark, tmp_dir):
    land(f"{tmp_dir}/in", "a.txt", "half past nine,30,70,10,7.0,P,q,Pakistan\n")
    run(spark, tmp_dir)
    row = spark.read.parquet(f"{tmp_dir}/watch").first()
    assert row.time is None and row.time_raw == "half past nine"


def test_custom_ladder_end_to_end(spark, tmp_dir):
    steps = ((8.0, "RED"), (7.0, "AMBER"), (6.0, "GREEN"))
    land(f"{tmp_dir}/in", "a.txt", "".join(LINE.format(d=1 + i, mag=m) for i, m in enumerate((5.5, 6.5, 7.5, 8.5))))
    run(spark, tmp_dir, steps=steps)
    assert sorted(r.mag for r in spark.read.parquet(f"{tmp_dir}/watch").collect()) == [7.5, 8.5]
    assert [r.mag for r in spark.read.parquet(f"{tmp_dir}/archive").collect()] == [8.5]
    frame = spark.createDataFrame([(5.5, "G"), (6.5, "G"), (7.5, "G"), (8.5, "G")], "mag double, region string")
    row = summary(frame, steps=steps).first()
    assert (row.critical_count, row.high_count) == (1, 1)


def endless(spark, name, fail=False):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def each(batch, batch_id):
        if fail:
            raise ValueError("made to fail")

    return rate.writeStream.queryName(name).foreachBatch(each).start()


def test_a_failing_second_query_surfaces_at_once(spark):
    queries = [endless(spark, "fine"), endless(spark, "fails", fail=True)]
    with pytest.raises(RuntimeError, match="made to fail"):
        run_bounded(queries)
    assert not any(q.isActive for q in queries)


def test_expiry_stops_all_queries(spark):
    queries = [endless(spark, "one"), endless(spark, "two")]
    with pytest.raises(TimeoutError):
        run_bounded(queries, timeout=1.0)
    assert not any(q.isActive for q in queries)


def test_awaiting_ignores_other_queries(spark):
    other, own = endless(spark, "other", fail=True), endless(spark, "own")
    while other.isActive:
        time.sleep(0.1)
    began = time.monotonic()
    await_any(spark, [own], timeout=1.5)
    assert time.monotonic() - began >= 1.5 and not own.isActive


def test_the_first_query_stops_if_the_second_does_not_start(spark, tmp_dir):
    land(f"{tmp_dir}/in", "a.txt", LINE.format(d=1, mag=7.0))
    alerts = alerts_from_lines(line_stream(spark, f"{tmp_dir}/in"))
    taken = endless(spark, "p_archive")
    try:
        with pytest.raises(Exception, match="p_archive"):
            start_alert_queries(alerts, f"{tmp_dir}/a", f"{tmp_dir}/c", f"{tmp_dir}/w", name_prefix="p")
        assert [q.name for q in spark.streams.active] == ["p_archive"]
    finally:
        taken.stop()


def test_printed_rows_say_what_is_left_out(spark, tmp_dir, capsys):
    land(f"{tmp_dir}/in", "a.txt", "".join(LINE.format(d=1 + i % 8, mag=7.0) for i in range(30)))
    alerts = alerts_from_lines(line_stream(spark, f"{tmp_dir}/in"))
    run_bounded([start_fused_alert_query(alerts, f"{tmp_dir}/a", f"{tmp_dir}/c", trigger={"availableNow": True}, console_rows=10)])
    assert "... and 20 more rows" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 30
