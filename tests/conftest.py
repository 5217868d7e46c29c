from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from fuelsight import schemas as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="fuelsight-test-")
    s = (SparkSession.builder.master("local[*]")
         .appName("fuelsight-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    """Timestamp literal helper: '2024-01-01 00:00:01.5'."""
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def signals_df(spark):
    def make(rows):
        return spark.createDataFrame([(v, T(t), st, float(x)) for v, t, st, x in rows], S.SIGNAL)
    return make
