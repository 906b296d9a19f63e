"""A failed task is retried and the written output is still whole and exact.

Runs in a subprocess: retries need a ``local[N,F]`` master, and one JVM holds
only one SparkContext. The failure is injected by a test-only Python UDF that
raises on the first attempt of one partition, after that attempt has already
written part of its output.
"""

from __future__ import annotations

import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(
    f"""
    import sys, tempfile
    sys.path.insert(0, {str(ROOT)!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from tremor.session import build_session
    from tremor.sinks import write_catalog
    from tremor.sources.fixture import load_catalog
    from tremor.operators import merge_feeds
    from tremor.sources.fixture import fixture_feeds

    spark = build_session("local[4,3]", conf={{"spark.sql.shuffle.partitions": "4"}})
    spark.sparkContext.setLogLevel("OFF")

    def _fail_first_attempt(event_id):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 1 and event_id % 50 == 49:
            raise RuntimeError("injected task failure")
        return True

    # non-deterministic, so the filter stays in the writing stage (after the
    # repartition) instead of being pushed down into the scan
    fail_first_attempt = F.udf(_fail_first_attempt, "boolean").asNondeterministic()

    catalog = load_catalog(spark, {SF_SMALL!r}).repartition(3, "event_id")
    flaky = catalog.filter(fail_first_attempt("event_id"))
    out = tempfile.mkdtemp(prefix="tremor-retry-")
    write_catalog(flaky, out + "/cat")
    back = spark.read.parquet(out + "/cat").select(*catalog.columns)
    assert back.count() == catalog.count(), (back.count(), catalog.count())
    assert back.exceptAll(catalog).count() == 0 and catalog.exceptAll(back).count() == 0

    merged = merge_feeds(list(fixture_feeds(spark, {SF_SMALL!r})))
    flaky_merge = merged.filter(fail_first_attempt("event_id"))
    write_catalog(flaky_merge, out + "/merged")
    again = spark.read.parquet(out + "/merged").select(*merged.columns)
    assert again.exceptAll(merged).count() == 0 and merged.exceptAll(again).count() == 0
    print("RETRY-OK", back.count(), again.count())
    """
)


def test_writes_survive_a_failed_task():
    done = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in done.stdout, done.stdout[-2000:] + done.stderr[-4000:]


def test_the_failure_is_really_injected():
    # same job without retries must fail, or the test above proves nothing
    done = subprocess.run([sys.executable, "-c", SCRIPT.replace("local[4,3]", "local[4]")],
                          capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" not in done.stdout and "injected task failure" in done.stderr
