"""Day, month and time-of-day expressions over a date-time column.

All of them take a ``timestamp`` or a ``timestamp_ntz`` column; NULL in gives NULL out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(stamp: Column | str) -> Column:
    """Calendar day of a date-time."""
    return F.to_date(stamp)


def year_month(stamp: Column | str) -> tuple[Column, Column]:
    """Year and month number."""
    return F.year(stamp), F.month(stamp)


def yyyymm(stamp: Column | str) -> Column:
    """Month as one integer, 2022-03 -> 202203."""
    year, month = year_month(stamp)
    return year * 100 + month


def yymm(stamp: Column | str) -> Column:
    """Month as one integer counted from 2000, 2022-03 -> 2203; negative before 2000."""
    return yyyymm(stamp) - 200000


def time_text(stamp: Column | str) -> Column:
    """Time of day as ``HH:mm:ss``.

    Cut from the text form: ``date_format`` would move a zone-less time into the session zone
    first, where an hour can be missing.
    """
    return F.substring(F.col(stamp).cast("string") if isinstance(stamp, str) else stamp.cast("string"), 12, 8)


def run_stamp(as_of: datetime | None = None) -> Column:
    """Time of the run as ``dd/MM/yyyy HH:mm:ss``, the same on every row."""
    if as_of is None:
        return F.date_format(F.current_timestamp(), "dd/MM/yyyy HH:mm:ss")
    return F.lit(as_of.strftime("%d/%m/%Y %H:%M:%S"))


def parse_day(text: str) -> Column:
    """Day from ``dd/MM/yyyy`` text; a constant, folded before the scan."""
    return F.to_date(F.lit(text), "dd/MM/yyyy")
