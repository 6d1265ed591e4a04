"""Set unions of a current table and its archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of either frame, by position, each different row once."""
    return first.union(second).distinct()


def union_of_sums(live: DataFrame, archive: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Set union of ``sum(value)`` per key over ``live`` and the same over ``archive``.

    A key summed in both frames gives one row if the sums are equal, else two; they are never
    added up. Both frames go through one grouping with a sum per side, so there is one shuffle,
    of rows already summed within each task.
    """
    sides = live.select(*keys, value, F.lit(True).alias("is_live")).union(
        archive.select(*keys, value, F.lit(False).alias("is_live"))
    )
    from_live = F.col("is_live")
    totals = sides.groupBy(*keys).agg(
        F.sum(F.when(from_live, F.col(value))).alias("live"),
        F.sum(F.when(~from_live, F.col(value))).alias("archived"),
        F.bool_or(from_live).alias("in_live"),
        F.bool_or(~from_live).alias("in_archive"),
    )
    live_sum, archived_sum = F.col("live"), F.col("archived")
    sums = (
        F.when(~F.col("in_archive") | (F.col("in_live") & live_sum.eqNullSafe(archived_sum)), F.array(live_sum))
        .when(~F.col("in_live"), F.array(archived_sum))
        .otherwise(F.array(live_sum, archived_sum))
    )
    return totals.select(*keys, F.explode(sums).alias(value))
