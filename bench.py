"""Benchmark: time the registered queries on one test-data folder.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3), ``BENCH_QUERIES`` (comma list, default
all), ``BENCH_EVENT_LOG_DIR`` (optional: write Spark's event log there),
``BENCH_SCALING`` (core counts for the workload scaling run, default 1,2,4;
empty to skip). The five-action workload is also timed over the catalog at
rest (written once by ``write_catalog``, outside the timers), which is what
the scaling run uses, and over a CSV copy of it: once read with an inferred
schema, once read as text and typed in one projection. Each query gets one warm-up run, then the median of
``BENCH_RUNS`` timed runs. A run executes the whole plan into Spark's ``noop`` sink, so nothing is
collected to the driver. Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tremor.plans.jobs import workload  # noqa: E402
from tremor.plans.registry import QUERIES  # noqa: E402
from tremor.session import build_session, scratch_path  # noqa: E402
from tremor.sinks import write_catalog, write_result  # noqa: E402
from tremor.sources import read_catalog  # noqa: E402
from tremor.sources.fixture import load_catalog  # noqa: E402

# The five actions of the reference's own timing workload come first.
WORKLOAD = ("catalog_count", "mag_range_counts", "region_counts", "top_places", "regional_avg_mag")


#: Speed-up on two and four cores that the reference's scaling script derives.
THEORETICAL_SPEEDUP = {"2": 1.74, "4": 2.76}


def write_large(spark, sf_dir: str, rows: int, path: str, tasks: int) -> int:
    """A catalog of at least ``rows`` rows: every event repeated at later times."""
    catalog = load_catalog(spark, sf_dir)
    n = catalog.count()
    copies = -(-rows // n)
    large = (catalog.repartition(4 * tasks).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
             .withColumns({"event_id": F.col("event_id") + F.col("copy") * n,
                           "time": F.timestamp_add("SECOND", F.col("copy"), F.col("time"))}).drop("copy"))
    write_catalog(large, path)
    return n * copies


def run_once(spark, fn, sf_dir) -> float:
    start = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = wanted or list(WORKLOAD) + [k for k in QUERIES if k not in WORKLOAD]

    conf = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
    }
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_log:  # stage/task timings, readable offline (no UI)
        os.makedirs(event_log, exist_ok=True)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(f"local[{cpus}]", app_name="tremor-bench", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")

    # The catalog at rest, as the catalog-build job leaves it: region folders,
    # several files each. Laid out once, outside every timer.
    stored = scratch_path(spark, "bench-catalog")
    write_catalog(load_catalog(spark, sf_dir).repartition(2 * cpus), stored)
    # The same catalog as one header CSV folder, for the CSV-input comparison.
    stored_csv = scratch_path(spark, "bench-catalog-csv")
    write_result(spark.read.parquet(stored), stored_csv, fmt="csv")

    large_rows = int(os.environ.get("BENCH_LARGE_ROWS", "50000000"))
    scaling_on = bool(os.environ.get("BENCH_SCALING", "1,2,4"))
    large = scratch_path(spark, "bench-catalog-large")
    if scaling_on:
        large_rows = write_large(spark, sf_dir, large_rows, large, cpus)
    median_workload(spark, stored, 1)

    timings: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        for _ in range(2):  # warm-up
            run_once(spark, fn, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 4)
        print(f"{name}: {timings[name]:.3f}s", file=sys.stderr, flush=True)

    # Workload-level timings are short and noisy at these sizes: take more runs.
    wruns = max(runs, 5)
    stored_workload = median_workload(spark, stored, wruns)
    print(f"workload on the stored catalog: {stored_workload:.3f}s", file=sys.stderr, flush=True)
    csv_inferred = median_workload(spark, stored_csv, wruns, fmt="csv-infer")
    csv_typed = median_workload(spark, stored_csv, wruns, fmt="csv")
    print(f"workload on CSV, inferred schema: {csv_inferred:.3f}s; typed in one projection: {csv_typed:.3f}s",
          file=sys.stderr, flush=True)
    spark.stop()
    scaling = measure_scaling(large, runs, conf) if scaling_on else {}

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "workload_sec": round(sum(timings[q] for q in WORKLOAD if q in timings), 4),
        "stored_catalog_workload_sec": round(stored_workload, 4),
        "csv_inferred_workload_sec": round(csv_inferred, 4),
        "csv_typed_workload_sec": round(csv_typed, 4),
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }
    if scaling:
        base = scaling.get("1")
        result["scaling_rows"] = large_rows
        result["workload_scaling_sec"] = scaling
        result["workload_rows_per_sec"] = {k: round(large_rows / v) for k, v in scaling.items()}
        if base:
            result["workload_speedup"] = {k: round(base / v, 3) for k, v in scaling.items()}
            result["theoretical_speedup"] = THEORETICAL_SPEEDUP
    print(json.dumps(result), flush=True)
    return 0


def median_workload(spark, catalog_path: str, runs: int, fmt: str = "parquet") -> float:
    """Median time of the five workload actions over a stored catalog (after a
    warm-up). The read is inside the timer, so ``fmt="csv-infer"`` (header CSV
    with ``inferSchema``, an extra pass over the file) pays its inference pass
    on every run; ``"csv"`` reads text and types it in one projection."""

    def once() -> float:
        start = time.perf_counter()
        if fmt == "csv-infer":
            catalog = spark.read.option("header", True).option("inferSchema", True).csv(catalog_path)
        else:
            catalog = read_catalog(spark, catalog_path, fmt=fmt)
        for df in workload(catalog).values():
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(runs))


def measure_scaling(catalog_path: str, runs: int, conf: dict) -> dict[str, float]:
    """The five-action workload over the stored catalog on local[n] for each n
    in ``BENCH_SCALING`` (default 1,2,4), each in a fresh session."""
    out = {}
    for n in [int(c) for c in os.environ.get("BENCH_SCALING", "1,2,4").split(",") if c]:
        spark = build_session(f"local[{n}]", app_name=f"tremor-bench-{n}",
                              conf={**conf, "spark.sql.shuffle.partitions": str(n)})
        spark.sparkContext.setLogLevel("ERROR")
        out[str(n)] = round(median_workload(spark, catalog_path, runs), 4)
        print(f"workload on local[{n}]: {out[str(n)]:.3f}s", file=sys.stderr, flush=True)
        spark.stop()
    return out


if __name__ == "__main__":
    sys.exit(main())
