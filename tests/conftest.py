import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("barframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="barframe-test-warehouse-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests run on a local session: give it a checkpoint folder only if none is configured.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barframe-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="barframe-test-")


def bars(spark, rows, with_copy=False):
    """Inline bars: rows of (ticker, 'YYYY-MM-DD', open, high, low, close, volume)."""
    import datetime as dt

    from barframe.schema import BAR_SCHEMA

    data = [(r[0], dt.date.fromisoformat(r[1]), *r[2:]) for r in rows]
    return spark.createDataFrame(data, BAR_SCHEMA)


def series(spark, closes, ticker="T", start="2024-01-01", volumes=None):
    """One series with the given closes on consecutive days (open = high = low = close)."""
    import datetime as dt

    d0 = dt.date.fromisoformat(start)
    vols = volumes if volumes is not None else [100.0] * len(closes)
    rows = [
        (ticker, (d0 + dt.timedelta(days=i)).isoformat(), c, c, c, c, v) for i, (c, v) in enumerate(zip(closes, vols))
    ]
    return bars(spark, rows)
