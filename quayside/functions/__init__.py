"""Column expressions shared by the reports."""

from quayside.functions.dates import (
    day,
    parse_day,
    run_stamp,
    time_text,
    year_month,
    yymm,
    yyyymm,
)
from quayside.functions.numbers import number_text, plain_decimal, plain_double, ratio

__all__ = [
    "day",
    "number_text",
    "parse_day",
    "plain_decimal",
    "plain_double",
    "ratio",
    "run_stamp",
    "time_text",
    "year_month",
    "yymm",
    "yyyymm",
]
