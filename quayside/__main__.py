"""``python -m quayside``, or the same through ``spark-submit``: run reports from a settings file.

The file is JSON: ``tables`` holds ``parquet`` (a folder; with ``blank_is_null``
set to true, empty text counts as NULL) or ``jdbc`` (the arguments of
``JdbcTables``, without password), ``reports`` holds the arguments per report, ``out`` is the
folder for the snapshots.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from quayside.jobs import read_arguments, run
from quayside.session import prepare
from quayside.sources import JdbcTables, ParquetTables, Split


def main() -> None:
    parser = argparse.ArgumentParser(prog="quayside", description="Write warehouse reports as CSV snapshots.")
    parser.add_argument("settings", help="JSON settings file")
    parser.add_argument("reports", nargs="*", help="reports to run; all in the file if none is named")
    parser.add_argument("--password-variable", help="environment variable with the database password")
    parser.add_argument("--compact", action="store_true", help="even out part files by size")
    options = parser.parse_args()

    with open(options.settings, encoding="utf-8") as file:
        settings = json.load(file)
    arguments = read_arguments(settings["reports"])
    if options.reports:
        arguments = {name: arguments[name] for name in options.reports}
    spark = prepare(SparkSession.builder.appName("quayside").getOrCreate())
    tables = open_tables(spark, settings["tables"], options.password_variable)
    run(tables, arguments, settings["out"], options.compact)


def open_tables(spark: SparkSession, source: dict, password_variable: str | None):
    """Table mapping for the ``tables`` part of the settings."""
    if "parquet" in source:
        return ParquetTables(spark, source["parquet"], source.get("blank_is_null", False))
    jdbc = dict(source["jdbc"])
    connection = dict(jdbc.pop("connection"))
    if password_variable:
        connection["password"] = os.environ[password_variable]
    splits = {name: Split(**cut) for name, cut in jdbc.pop("splits", {}).items()}
    return JdbcTables(spark, connection, splits=splits, **jdbc)


if __name__ == "__main__":
    main()
