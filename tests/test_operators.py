from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside.operators import (
    keep_listed,
    lookup,
    named,
    not_in,
    scope,
    since,
    single_value_lookup,
    union_distinct,
    union_of_sums,
)


def values(rows) -> list[tuple]:
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def test_scope(spark):
    rows = spark.createDataFrame([("S1", "C1", 1), ("S1", "C2", 2), ("S2", "C1", 3), (None, "C1", 4)], "site string, client string, n int")
    assert values(scope(rows, site="S1", client="C1").select("n")) == [(1,)]


def test_not_in_drops_null(spark):
    rows = spark.createDataFrame([("SCRAP",), ("DOCK1",), (None,)], "dock string")
    assert values(rows.filter(not_in("dock", ["SCRAP", "RETURN"]))) == [("DOCK1",)]


def test_since_includes_its_first_moment(spark):
    rows = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2021-12-31 23:59:59', TIMESTAMP_NTZ '2022-01-01 00:00:00')) AS dstamp")
    assert since(rows, date(2022, 1, 1)).count() == 1


def test_lookup_keeps_unmatched_and_repeats_matches(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("\x003", 4)], "key string, n int")
    names = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("\x003", "w")], "id string, name string")
    got = lookup(rows, names, {"key": "id"}).select("n", "name")
    assert values(got) == values(spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (3, None), (4, "w")], got.schema))


def test_lookup_ignores_a_stand_in_key_in_the_dimension(spark):
    rows = spark.createDataFrame([(None, 1)], "key string, n int")
    stand_ins = spark.range(512).select(F.concat(F.lit("\0"), F.col("id").cast("string")).alias("id"))
    assert values(lookup(rows, stand_ins, {"key": "id"}).select("n", "id")) == [(1, None)]


def test_lookup_on_two_keys_needs_both(spark):
    rows = spark.createDataFrame([("a", "p", 1), ("a", None, 2), (None, "p", 3)], "k1 string, k2 string, n int")
    other = spark.createDataFrame([("a", "p"), ("a", None), (None, "p")], "o1 string, o2 string")
    got = lookup(rows, other, {"k1": "o1", "k2": "o2"})
    assert got.columns == ["k1", "k2", "n", "o1", "o2"]
    assert [row["n"] for row in got.collect() if row["o1"]] == [1]
    assert got.count() == 3


def test_keep_listed_does_not_multiply(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "key string, n int")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert values(keep_listed(rows, "key", listed).select("n")) == [(1,), (2,)]


ZONES = [("L1", "A"), ("L1", "A"), ("L2", "A"), ("L2", "B"), ("L3", None), ("L3", None), ("L4", "A"), ("L4", None)]


@pytest.mark.parametrize(("place", "zone"), [("L1", "A"), ("L3", None), ("L9", None), (None, None)])
def test_single_value_lookup(spark, place, zone):
    rows = spark.createDataFrame([(place, 1)], "place string, n int")
    zones = spark.createDataFrame(ZONES, "id string, zone string")
    assert values(single_value_lookup(rows, "place", zones, "id", "zone")) == [(place, 1, zone)]


@pytest.mark.parametrize("place", ["L2", "L4"])
def test_single_value_lookup_rejects_two_values(spark, place):
    rows = spark.createDataFrame([(place, 1)], "place string, n int")
    zones = spark.createDataFrame(ZONES, "id string, zone string")
    with pytest.raises(PySparkException, match="SCALAR_SUBQUERY_TOO_MANY_ROWS.*" + place):
        single_value_lookup(rows, "place", zones, "id", "zone").collect()


def test_named_goes_by_position(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert named(rows, ["b", "Date/hour"]).columns == ["b", "Date/hour"]
    with pytest.raises(ValueError, match="2 columns for 1 names"):
        named(rows, ["a"])


def test_union_distinct_treats_nulls_as_equal(spark):
    first = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    second = spark.createDataFrame([(1, None), (3, "x")], "c int, d string")
    assert values(union_distinct(first, second)) == [(1, None), (2, "x"), (3, "x")]


def test_union_of_sums(spark):
    schema = "key string, qty decimal(18,4)"
    live = spark.createDataFrame([], schema).union(
        spark.sql("""SELECT * FROM VALUES ('same', 2), ('same', 3), ('differs', 2), ('live', 4), (NULL, 1),
                     ('null', NULL), ('null and sum', NULL), ('live null', NULL) AS t(key, qty)""")
    )
    archive = spark.createDataFrame([], schema).union(
        spark.sql("""SELECT * FROM VALUES ('same', 5), ('differs', 3), ('archived', 4), (NULL, 1),
                     ('null', NULL), ('null and sum', 7) AS t(key, qty)""")
    )

    def sums(rows):
        return rows.groupBy("key").agg(F.sum("qty").alias("qty"))

    got = union_of_sums(live, archive, ["key"], "qty")
    assert values(got) == values(sums(live).union(sums(archive)).distinct())
    assert sorted(str(row["key"]) for row in got.collect()) == sorted(
        ["None", "archived", "differs", "differs", "live", "live null", "null", "null and sum", "null and sum", "same"]
    )
