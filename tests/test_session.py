from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quayside import session
from quayside.session import MOST_CUTS, OWN_CUTS, SHUFFLE_CUTS, input_bytes, shuffle_cuts, size_shuffles

MB, GB, TB = 1 << 20, 1 << 30, 1 << 40


@pytest.mark.parametrize(
    ("size", "cuts"),
    [(0, 24), (1 * GB, 24), (10 * GB, 160), (1 * TB, 16_384), (5 * TB, 81_920), (100 * TB, MOST_CUTS)],
)
def test_cuts_follow_the_data(size, cuts):
    assert shuffle_cuts(size, 64 * MB, least=24) == cuts


def test_the_size_is_that_of_all_scans(spark, tmp_path):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    one = spark.read.parquet(f"{tmp_path}/t")
    assert input_bytes(one) > 100_000
    assert input_bytes(one.join(one.withColumnRenamed("id", "other"), one["id"] == 1)) == 2 * input_bytes(one)


def test_a_report_gets_its_own_cut_unless_the_session_sets_one(spark, settings, monkeypatch):
    rows = spark.range(10)
    monkeypatch.setattr(session, "input_bytes", lambda rows: 10 * GB)
    before = spark.conf.get(SHUFFLE_CUTS)
    settings(**{SHUFFLE_CUTS.replace(".", "__"): before, OWN_CUTS.replace(".", "__"): before})
    size_shuffles(rows)
    assert spark.conf.get(SHUFFLE_CUTS) == "160"
    spark.conf.set(SHUFFLE_CUTS, "7")
    size_shuffles(rows)
    assert spark.conf.get(SHUFFLE_CUTS) == "7"


def test_a_task_gets_small_pieces_of_shuffles_and_files(spark, tmp_path):
    numbers = spark.range(8_000_000).select(F.xxhash64("id").alias("h"))  # 60 MB that do not pack
    assert numbers.repartition("h").rdd.getNumPartitions() >= 4
    numbers.coalesce(1).write.option("parquet.block.size", 8 * MB).parquet(f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").repartition("h").count() == 8_000_000
    assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() >= 2


def test_sizes_that_the_session_sets_stay(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="5MB", spark__sql__files__maxPartitionBytes="7MB")
    session.prepare(spark)
    assert (spark.conf.get(session.ADVISORY), spark.conf.get("spark.sql.files.maxPartitionBytes")) == ("5MB", "7MB")
