from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from quayside.functions import (
    day,
    number_text,
    parse_day,
    plain_decimal,
    plain_double,
    ratio,
    run_stamp,
    time_text,
    yymm,
    yyyymm,
)

MOMENTS = [
    ("1999-12-31 23:59:59", date(1999, 12, 31), 199912, -88, "23:59:59"),
    ("2000-01-01 00:00:00", date(2000, 1, 1), 200001, 1, "00:00:00"),
    ("2022-02-28 23:59:59.999999", date(2022, 2, 28), 202202, 2202, "23:59:59"),
    ("2022-03-01 00:00:00", date(2022, 3, 1), 202203, 2203, "00:00:00"),
    ("2022-03-27 02:30:00", date(2022, 3, 27), 202203, 2203, "02:30:00"),
    (None, None, None, None, None),
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_days_months_and_times(spark, kind):
    rows = spark.createDataFrame([(text,) for text, *_ in MOMENTS], "text string")
    stamp = F.col("text").cast(kind)
    got = rows.select("text", day(stamp), yyyymm(stamp), yymm(stamp), time_text(stamp)).collect()
    assert {tuple(row) for row in got} == set(MOMENTS)


def test_a_local_time_does_not_depend_on_the_session_zone(spark, settings):
    settings(spark__sql__session__timeZone="Europe/Paris")
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2022-03-27 02:30:00' AS stamp")
    assert rows.select(day("stamp"), time_text("stamp")).first() == (date(2022, 3, 27), "02:30:00")


def test_run_stamp_is_the_same_on_all_rows(spark):
    rows = spark.range(100)
    assert {row[0] for row in rows.select(run_stamp(datetime(2022, 1, 2, 8))).collect()} == {"02/01/2022 08:00:00"}
    (now,) = {row[0] for row in rows.select(run_stamp()).collect()}
    assert datetime.strptime(now, "%d/%m/%Y %H:%M:%S").year >= 2024


def test_parse_day(spark):
    assert spark.range(1).select(parse_day("01/12/2022")).first()[0] == date(2022, 12, 1)


def test_ratio_keeps_all_places_and_rejects_zero(spark):
    amounts = spark.sql("SELECT CAST(1 AS DECIMAL(18,4)) AS a, CAST(3 AS DECIMAL(18,4)) AS b, CAST(0 AS DECIMAL(18,4)) AS z")
    assert amounts.select(ratio("a", "b")).first()[0] == 1 / 3
    with pytest.raises(ArithmeticException, match="DIVIDE_BY_ZERO"):
        amounts.select(ratio("a", "z")).collect()


def test_number_text(spark):
    assert spark.sql("SELECT 120304050607L AS key").select(number_text("key")).first()[0] == "120304050607"


def test_plain_decimal(spark):
    texts = ["12.0000", "12.5000", "0.0000", "-0.0500", "100.0000", None]
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    got = rows.select(plain_decimal(F.col("text").cast("decimal(18,4)"))).collect()
    assert [row[0] for row in got] == ["12", "12.5", "0", "-0.05", "100", None]
    wide = spark.sql("SELECT CAST(0 AS DECIMAL(38,8)) AS zero").select(plain_decimal("zero"))
    assert wide.first()[0] == "0"


def test_plain_double(spark):
    numbers = [12.0, 0.1, 1.5e7, 123456789.25, 1e-4, -2.5e-5, 1e300, None]
    rows = spark.createDataFrame([(number,) for number in numbers], "number double")
    got = [row[0] for row in rows.select(plain_double("number")).collect()]
    assert got == ["12.0", "0.1", "15000000.0", "123456789.25", "0.0001", "-0.000025", "1" + "0" * 300 + ".0", None]


def test_plain_double_reads_back_equal_without_exponent(spark):
    pick = random.Random(1)
    numbers = [3.3333333333333335e-05, 1.234567890123456e-05, 1 / 3000, 2.5e-7, 1e18, 5e-324, 1.7976931348623157e308, -0.0, 1e21, -1e-300]
    numbers += [pick.choice([-1, 1]) * pick.random() * 10.0 ** pick.randrange(-300, 300) for _ in range(3000)]
    rows = spark.createDataFrame([(number,) for number in numbers], "number double")
    for number, text in rows.select("number", plain_double("number")).collect():
        assert "E" not in text and float(text) == number, (number, text)


def test_plain_decimal_of_many_places(spark):
    texts = ["0.0000000000450", "-0.0000001", "123456789012345678.10", "0E-12"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    got = rows.select(plain_decimal(F.col("text").cast("decimal(38,18)"))).collect()
    assert [row[0] for row in got] == ["0.000000000045", "-0.0000001", "123456789012345678.1", "0"]
