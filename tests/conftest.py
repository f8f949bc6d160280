from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session in a zone with daylight saving: no result may depend on it."""
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventstats-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """``values(column, [text, ...])`` -> list of results, in order."""

    def run(fn, rows, schema):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        return [r[0] for r in df.orderBy("_i").select(fn.alias("v")).collect()]

    return run


def plan_of(df) -> str:
    """The plan text that ``explain`` prints."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
