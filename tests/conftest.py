from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quayside.session import prepare  # noqa: E402
from quayside.sources import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def table(spark):
    """Make a warehouse table of a few rows, given as dictionaries; missing columns are NULL."""

    def make(name: str, *rows: dict):
        schema = SCHEMAS[name]
        unknown = {column for row in rows for column in row} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(column) for column in schema.names) for row in rows], schema)

    return make


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values: str):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
