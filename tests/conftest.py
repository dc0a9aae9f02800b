from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column function over literal values; returns the list of results."""

    def evaluate(build, values, type_="string"):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, v {type_}")
        rows = frame.select("n", build(F.col("v")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.n)]

    return evaluate
