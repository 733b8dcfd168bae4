import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codesift.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column function on plain values; gives one result per value."""

    def run(function, values, kind="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in
                df.orderBy("i").select(function(F.col("v")).alias("r")).collect()]

    return run
