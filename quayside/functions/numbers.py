"""Quotients, and numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(dividend: Column | str, divisor: Column | str) -> Column:
    """Quotient as a double; a zero divisor is an error.

    Decimals are cast first, as a decimal quotient would be cut to six places.
    """
    return _column(dividend).cast("double") / _column(divisor).cast("double")


def number_text(number: Column | str) -> Column:
    """Whole number as text."""
    return _column(number).cast("string")


def plain_decimal(number: Column | str) -> Column:
    """Decimal with a fraction part as text without trailing zeros: 12.5000 -> 12.5, 12.0000 -> 12."""
    return F.rtrim(F.rtrim(_without_exponent(_column(number).cast("string")), F.lit("0")), F.lit("."))


def plain_double(number: Column | str) -> Column:
    """Floating-point number as text without an exponent: 1.5E7 -> 15000000.0.

    All digits that Spark needs to write the number come from its own text, so the result reads
    back as the same number, however large or small.
    """
    return _without_exponent(_column(number).cast("string"))


def _without_exponent(text: Column) -> Column:
    """The text of a number, its decimal point moved to where the exponent puts it."""
    mantissa = F.split(text, "E")[0]
    exponent = F.get(F.split(text, "E"), F.lit(1)).cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, "[-.]", ""), "(?<=.)0+$", "")
    fraction = F.substr(digits, exponent + 2)
    large = F.concat(F.rpad(digits, exponent + 1, F.lit("0")), F.lit("."), F.when(fraction == "", "0").otherwise(fraction))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.when(text.contains("E"), F.concat(sign, F.when(exponent < 0, small).otherwise(large))).otherwise(text)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
