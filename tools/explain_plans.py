"""Write PLANS.md: the physical plan tree of every registered query.

    python tools/explain_plans.py [sf_dir] > PLANS.md

Round-trip queries, which write files before returning, are listed with the
plan of the frame they return; the two stream keys with their streaming plan.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tremor.plans.registry import QUERIES  # noqa: E402
from tremor.session import build_session  # noqa: E402

EAGER = {"build_catalog_from_csv", "catalog_by_date_roundtrip", "csv_roundtrip", "catalog_roundtrip", "decode_lines", "stream_watch_alerts", "stream_critical_alerts"}


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n", 1)[0]
    scans = [line for line in text.splitlines()
             if line.startswith(("ReadSchema", "PushedFilters", "PartitionFilters", "Arguments: hashpartitioning",
                                 "Arguments: rangepartitioning", "Arguments: SinglePartition", "Functions"))]
    scans = [re.sub(r"#\d+L?", "", s) for s in scans]
    return head + "\n\n" + "\n".join(scans)


def stream_frames(spark, sf_dir):
    """The unstarted streaming frames behind the two stream query keys."""
    from tremor.session import scratch_path
    from tremor.sinks import write_lines
    from tremor.sources.fixture import load_catalog
    from tremor.streaming import alerts_from_lines, critical_alerts, line_stream, watch_alerts

    lines = scratch_path(spark, "plan-lines")
    write_lines(load_catalog(spark, sf_dir), lines)
    alerts = alerts_from_lines(line_stream(spark, lines))
    return {"stream_watch_alerts": watch_alerts(alerts), "stream_critical_alerts": critical_alerts(alerts)}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}` (Spark {spark.version}, AQE on; "
          "plans shown before adaptive re-optimization). Queries that write files first are "
          "shown by the plan of the frame they return.\n")
    streams = stream_frames(spark, sf_dir)
    for key, fn in QUERIES.items():
        df = streams[key] if key in streams else fn(spark, sf_dir)
        note = " (the streaming query itself)" if key in streams else ""
        print(f"## {key}{note}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
