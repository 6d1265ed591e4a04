"""Row filters. Each one compares bare columns with constants, so scans can take it over."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import yymm

MONTH_FOLDER = "yymm"
DAY = "stamp_day"


def scope(rows: DataFrame, **owner: str) -> DataFrame:
    """Rows of one site, client, or whichever columns are named: ``scope(df, site_id="S1")``."""
    return rows.filter(reduce(and_, (F.col(column) == value for column, value in owner.items())))


def since(rows: DataFrame, start: date | Column, stamp: str = "dstamp") -> DataFrame:
    """Rows stamped at or after ``start``.

    If the table lies in month folders, whole folders before ``start`` are left out as well, and within the first month
    row groups of earlier days. Files written without a day column have NULL there and are read whole.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    if MONTH_FOLDER in rows.columns:
        rows = rows.filter(F.col(MONTH_FOLDER) >= yymm(start))
    if DAY in rows.columns:
        rows = rows.filter(F.col(DAY).isNull() | (F.col(DAY) >= F.to_date(start)))
    return rows.filter(F.col(stamp) >= start)


def not_in(column: str, values: Sequence[str]) -> Column:
    """SQL ``NOT IN`` over constants: a NULL is neither in nor out, so its row is dropped."""
    return ~F.col(column).isin(*values)
