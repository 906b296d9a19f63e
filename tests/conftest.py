from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tremor.session import build_session

    session = build_session(
        "local[8]",
        app_name="tremor-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tremor-test-")


@pytest.fixture(scope="session")
def catalog_small(spark):
    from tremor.sources.fixture import load_catalog

    return load_catalog(spark, SF_SMALL)
