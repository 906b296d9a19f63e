"""Session construction and shared scratch locations."""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)

# Defaults for sessions built here. Results do not depend on the time zone
# (catalog times are UTC wall clocks); UTC only makes zoned values print as UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


GIB = 1 << 30


def sizing_conf(input_bytes: int, total_cores: int, shuffle_partition_bytes: int = GIB,
                max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Partition sizes for a catalog of ``input_bytes`` on ``total_cores`` cores.

    * scan splits of 256 MiB: large enough to amortize task start-up over
      thousands of files, small enough for the vectorized reader's batches;
    * initial shuffle partitions sized for the one shuffle that carries whole
      rows (the merge's keep-first dedupe): about 1 GiB of input each, at least
      two waves of the cluster, capped so the map × reduce block count stays
      manageable. Aggregates shuffle only partial rows and AQE coalesces them
      down to ``advisoryPartitionSizeInBytes``.
    """
    wanted = -(-int(input_bytes) // shuffle_partition_bytes)
    partitions = max(2 * total_cores, min(wanted, max_shuffle_partitions))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }


def build_session(master: str | None = None, app_name: str = "tremor", conf: dict | None = None) -> SparkSession:
    """A session with the library defaults; ``conf`` entries win (merge in
    :func:`sizing_conf` for cluster runs)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes stored under ``paths`` (files, folders or globs), from the file system
    that holds them. What it cannot tell counts nothing: the size only picks
    partition numbers. Compressed files count as they are stored."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        try:
            location = sc._jvm.org.apache.hadoop.fs.Path(path)
            fs = location.getFileSystem(conf)
            total += sum(fs.getContentSummary(found.getPath()).getLength() for found in fs.globStatus(location) or [])
        except Py4JJavaError as exc:
            logger.warning("size of %s is not known: %s", path, exc.java_exception)
    return total


def size_for(spark: SparkSession, paths, shuffle_partitions: int | None = None) -> dict[str, str]:
    """Set :func:`sizing_conf` for a job that reads ``paths`` (``shuffle_partitions``
    overrides the derived number); returns what was set."""
    conf = sizing_conf(input_bytes(spark, paths), spark.sparkContext.defaultParallelism)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def scratch_root(spark: SparkSession) -> str:
    """Base folder for intermediate tables and streaming checkpoints.

    The cluster's shared ``spark.checkpoint.dir`` (or the directory set with
    ``setCheckpointDir``) is used as is. Only when neither is set — a local
    test session — a fresh temporary folder is created and registered as the
    checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    try:  # classic sessions only (a Spark Connect client has no SparkContext)
        sc = spark.sparkContext
    except Exception as exc:  # noqa: BLE001
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder") from exc
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="tremor-")
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under :func:`scratch_root` (not created)."""
    return f"{scratch_root(spark)}/tremor/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Materialize ``df`` in the shared checkpoint folder and cut its lineage,
    so later jobs (and retries after a lost executor) read it back instead of
    recomputing it from the source."""
    scratch_root(df.sparkSession)  # makes sure a checkpoint folder is set
    return df.checkpoint(eager=True)
