"""Helpers that several operators of this folder use."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import quayside
from quayside.session import scratch

#: Lower case for A to Z only; other letters stay as they are.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it, whatever folder they start in.

    On a cluster whose machines share no such folder, install the library or pass it by ``--py-files``.
    """
    root = str(Path(quayside.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the folder that driver and executors share and read again.

    Cuts the lineage: an executor lost later costs no more than reading a file again.
    """
    spark = rows.sparkSession
    path = scratch(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, however often lambdas inside ``use`` refer to it."""
    return F.transform(F.array(value), use)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, in any case of its letters."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which Spark does not hash, by their entries."""
    kinds = dict(docs.dtypes)
    columns = [F.map_entries(f"`{c}`") if kinds[c].startswith("map<") else F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*columns)


#: Numbers that a table may hold to be broadcast: some tens of MB in memory.
SMALL = 2_000_000


def small_enough(rows: DataFrame, *lists: str) -> DataFrame:
    """The rows, marked for a broadcast if they are proven to hold ``SMALL`` values at most; else Spark shuffles both sides.

    Counted are the rows' columns, and the elements of the array columns ``lists``. For stored tables of
    numbers and short texts, cheap to read twice.
    """
    values = F.lit(len(rows.columns)).cast("long")
    for name in lists:
        values = values + F.coalesce(F.size(name), F.lit(0))
    held = rows.agg(F.sum(values)).first()[0] or 0
    return F.broadcast(rows) if held <= SMALL else rows
