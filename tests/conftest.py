import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from earshot.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def column(spark):
    """Evaluate a Column function over values of one type: [function(value), ...]."""

    def evaluate(function, values, dtype):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r[1] for r in sorted(frame.select("i", function(F.col("v"))).collect())]

    return evaluate
