"""Joins that plain ``DataFrame.join`` does not spell out.

No broadcast hints here: Spark broadcasts a side by its estimated or measured size, else shuffles
both sides and splits hot keys at run time (``quayside.session``). It can split a key only where
both sides come straight from a shuffle made for that join, and only on a side that is not
looked up. The helpers below see to both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import current_cuts

SLOTS_PER_CUT = 64  # so many stand-in keys per piece of a shuffle spread evenly


def keep_listed(rows: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the values of the one-column frame ``listed``.

    A semi join needs no distinct list, but a value listed over and over must not travel over
    and over: each task first drops its own repeats.
    """
    once_per_task = listed.toDF(column).select(column, F.spark_partition_id()).distinct()
    return rows.join(once_per_task.select(column), column, "left_semi")


def lookup(
    rows: DataFrame, dimension: DataFrame, on: dict[str, str], keep: Sequence[str] | None = None, aligned: bool = False
) -> DataFrame:
    """Left outer join on ``{column of rows: column of dimension}``, the first column being text.

    A row without a match is kept, a repeated match repeats it. The dimension's key columns stay,
    NULL where nothing matched. A row with a NULL key matches nothing, but plainly joined all such
    rows would meet in one task: each gets one of many stand-in keys by the hash of its values, and
    the last condition keeps those from matching. There are as many as the shuffle has pieces, and more.

    ``keep`` names the columns of ``rows`` that are wanted, besides those of the key. The hash names
    every column, so all of them are read: give ``keep``, or select before.

    ``aligned`` says that both sides lie together by the first key, which is never NULL: rows that lack another key
    then stay where they are, and nothing needs a stand-in.
    """
    if keep is not None:
        rows = rows.select(*dict.fromkeys([*on, *keep]))
    if aligned:
        return rows.join(dimension, [F.col(key) == F.col(other) for key, other in on.items()], "left")
    slots = SLOTS_PER_CUT * current_cuts(rows.sparkSession)
    first = next(iter(on))
    complete = reduce(and_, (F.col(key).isNotNull() for key in on))
    slot = F.expr(f"CAST(pmod(xxhash64(*), {slots}) AS STRING)")
    spread = F.when(complete, F.col(first)).otherwise(F.concat(F.lit("\0"), slot))
    marked = rows.withColumns({"_key": spread, "_complete": complete})
    match = [F.col("_key" if key == first else key) == F.col(other) for key, other in on.items()]
    return marked.join(dimension, [*match, F.col("_complete")], "left").drop("_key", "_complete")


def single_value(rows: DataFrame, keys: Sequence[str], value: str, *more: Column) -> DataFrame:
    """One row per key with its only ``value`` and ``ambiguous``, true if there is more than one.

    A NULL counts as a value of its own. ``checked_value`` turns the pair into a result. ``more``
    aggregates of the same group come along.
    """
    low, high, known = F.min(value), F.max(value), F.count(value)
    several = F.coalesce(low != high, F.lit(False)) | ((known > 0) & (known < F.count("*")))
    return rows.groupBy(*keys).agg(low.alias(value), several.alias("ambiguous"), *more)


def checked_value(key: str, value: str) -> Column:
    """Column ``value`` of ``single_value``; fails the query on a row whose key is ambiguous."""
    message = F.concat(
        F.lit(f"SCALAR_SUBQUERY_TOO_MANY_ROWS: more than one {value} for {key} "), F.col(key)
    )
    return F.when(F.col("ambiguous"), F.raise_error(message)).otherwise(F.col(value))


def single_value_lookup(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str) -> DataFrame:
    """Add ``value`` of the matching key: NULL without a match, an error with two different ones.

    A scalar subquery would do the same, but its join cannot split a hot key. Here the looked-up
    side has one row per key, and the join is an ordinary left one. The key is looked up through
    an expression: Spark would take the column as already shuffled by the grouping.
    """
    singles = single_value(table, [table_key], value)
    found = singles.select(F.concat(table_key, F.lit("")).alias("_found"), value, "ambiguous")
    return lookup(rows, found, {key: "_found"}).select(*rows.columns, checked_value(key, value).alias(value))
