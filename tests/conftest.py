from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark import SparkConf

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pagefold.session import get_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Spark's defaults may name a shared folder; where they do not, tests bring their own.
    conf = SparkConf()
    shared = conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tests-")
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a Column function over a list of strings."""

    def run(function, values):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "i int, text string")
        out = frame.select("i", function(F.col("text")).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return run
