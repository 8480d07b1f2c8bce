from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.sources import schemas  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="wardline-tests-")
    s = (SparkSession.builder.master("local[*]").appName("wardline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.local.dir", scratch)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():          # only where unset, as in tests
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


def ts(day: int = 1, hour: int = 0, minute: int = 0, second: int = 0, micro: int = 0):
    return dt.datetime(2020, 1, day, hour, minute, second, micro)


@pytest.fixture(scope="session")
def make(spark):
    """``make(name, rows)``: a source table with its declared schema."""
    def _make(name: str, rows: list[tuple]):
        return spark.createDataFrame(rows, schemas.SOURCES[name])
    return _make
