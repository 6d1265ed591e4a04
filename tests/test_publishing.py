"""Snapshots of one job together, writers that overlap, and months of a history exchanged one by one."""

from __future__ import annotations

import os
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import ArithmeticException

from quayside import files, jobs
from quayside.files import Folder, Replacement, publish_all
from quayside.operators import since
from quayside.sinks import csv, snapshot_folder, stage_snapshot, write_snapshot
from quayside.sources import ParquetTables, write_by_month


def tree(folder) -> dict[str, bytes]:
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(Path(folder).rglob("*")) if p.is_file()}


def lines(spark, path) -> list[str]:
    return [line for part in sorted(Path(snapshot_folder(spark, path)).glob("part-*")) for line in part.read_text().splitlines()]


# --- several reports -------------------------------------------------------------------------


@pytest.fixture
def two_reports(spark, table):
    """Tables, and arguments of two reports of which the second can be made to fail."""
    here = {"site_id": "S1", "client_id": "C1"}
    receipt = {**here, "sku_id": "K1", "code": "Receipt", "condition_id": "PPACK", "dstamp": datetime(2022, 3, 5), "update_qty": Decimal(6), "supplier_id": "A"}

    def tables(multiple: int, gates: int = 1):
        return {
            "order_container": table("order_container", *[{"v_site_id": "S1", "v_container_type": "71", "dstamp": datetime(2022, 1, 2)}] * gates),
            "inventory_transaction": table("inventory_transaction", receipt),
            "inventory_transaction_archive": table("inventory_transaction_archive"),
            "v_sku_properties": table("v_sku_properties", {**here, "sku_id": "K1", "gate_id": "G", "sales_multiple": Decimal(multiple), "standard_cost": Decimal(1)}),
            "v_prepack_mat_codes": table("v_prepack_mat_codes", {**here, "sku_id": "K1", "prepack_code": "P"}),
            "v_prepack_materials": table("v_prepack_materials", {**here, "sku_id": "K1", "sequence_num": 1, "material_sku_id": "M"}),
            "address": table("address", {"address_id": "A", "client_id": "C1", "name": "N"}),
        }

    arguments = {
        "cartons": {"site": "S1", "types": ["71"], "since": date(2022, 1, 1)},
        "prepack_in": {"site": "S1", "client": "C1", "conditions": ["PPACK"], "code": "Receipt"},
    }
    return tables, arguments


def test_a_report_that_fails_keeps_the_others_as_they_are(spark, two_reports, tmp_path):
    tables, arguments = two_reports
    jobs.run(tables(2), arguments, str(tmp_path))
    before = tree(tmp_path)
    assert lines(spark, f"{tmp_path}/cartons")[1].endswith(";1") and len(lines(spark, f"{tmp_path}/prepack_in")) == 2
    with pytest.raises(ArithmeticException, match="DIVIDE_BY_ZERO"):
        jobs.run(tables(0, gates=3), arguments, str(tmp_path))
    assert tree(tmp_path) == before
    jobs.run(tables(3, gates=3), arguments, str(tmp_path))
    assert lines(spark, f"{tmp_path}/cartons")[1].endswith(";3")
    assert [p.name for p in sorted(tmp_path.iterdir())] == ["cartons", "prepack_in"]


@pytest.mark.parametrize("pointer", [False, True])
def test_a_failure_while_publishing_takes_all_back(spark, tmp_path, pointer, monkeypatch):
    paths = [f"{tmp_path}/{name}" for name in ("a", "b", "new")]
    for path in paths[:2]:
        write_snapshot(spark.range(1), path, pointer=pointer)
    before = tree(tmp_path)
    staged = [stage_snapshot(spark.range(5), path, pointer=pointer) for path in paths]

    class Broken:
        files = staged[0].files

        def publish(self):
            raise OSError("the store is gone")

        def discard(self):
            pass

    with pytest.raises(OSError, match="store is gone"):
        publish_all([*staged, Broken()])
    assert tree(tmp_path) == before


# --- several writers -------------------------------------------------------------------------


@pytest.mark.parametrize("pointer", [False, True])
@pytest.mark.parametrize("first", [0, 1])
def test_writers_that_overlap_leave_a_whole_snapshot(spark, tmp_path, pointer, first):
    out = f"{tmp_path}/report"
    write_snapshot(spark.sql("SELECT 'old' AS id"), out, pointer=pointer)
    both = [stage_snapshot(spark.sql(f"SELECT '{name}' AS id"), out, pointer=pointer) for name in ("one", "two")]
    publish_all([both[first]])
    assert lines(spark, out) == ["id", ("one", "two")[first]]
    publish_all([both[1 - first]])
    assert lines(spark, out) == ["id", ("two", "one")[first]]
    assert [p.name for p in tmp_path.iterdir()] == ["report"]


def test_a_run_at_work_outlives_the_cleaning_of_others(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/report"
    slow = stage_snapshot(spark.sql("SELECT 'slow' AS id"), out, pointer=True)
    for number in range(4):
        write_snapshot(spark.range(number, number + 1), out, pointer=True)
    assert len([p for p in Path(out).iterdir() if p.name.startswith("run-")]) == 3
    publish_all([slow])
    assert lines(spark, out) == ["id", "slow"]

    lost = stage_snapshot(spark.sql("SELECT 'lost' AS id"), out, pointer=True)
    monkeypatch.setattr(csv, "ABANDONED", -1)
    write_snapshot(spark.sql("SELECT 9 AS id"), out, pointer=True)
    assert not Path(lost.files.child(lost._run)).exists() and lines(spark, out) == ["id", "9"]


def test_only_one_writer_publishes_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Folder, "WAIT", 0.5)
    folder = Folder(spark, f"{tmp_path}/report")
    change = stage_snapshot(spark.range(1), folder.path)
    with folder.locked(), pytest.raises(TimeoutError, match="another writer"):
        publish_all([change])
    assert list(tmp_path.iterdir()) == []

    lock = Path(folder.beside("lock"))
    lock.touch()
    os.utime(lock, (time.time() - 3600,) * 2)  # that of a writer long lost
    write_snapshot(spark.sql("SELECT 0 AS id"), folder.path)
    assert lines(spark, folder.path) == ["id", "0"] and not lock.exists()


def test_a_folder_is_never_moved_into_another(spark, tmp_path):
    for name in ("new", "at"):
        (tmp_path / name).mkdir()
    folder = Folder(spark, str(tmp_path))
    with pytest.raises(OSError, match="cannot be renamed"):
        folder.rename(folder.child("new"), folder.child("at"))


# --- months of a history ---------------------------------------------------------------------

MOVE = {"sku_id": "K1", "update_qty": Decimal("1.5"), "tag_id": "T1"}


@pytest.fixture
def archive(spark, table, tmp_path):
    path = f"{tmp_path}/inventory_transaction_archive"

    def rows(*moments: datetime, tag: str = "T1"):
        return table("inventory_transaction_archive", *({**MOVE, "dstamp": moment, "tag_id": tag} for moment in moments))

    def read():
        found = ParquetTables(spark, str(tmp_path))["inventory_transaction_archive"]
        return sorted((row["dstamp"], row["tag_id"]) for row in found.collect())

    return path, rows, read


DAYS = [datetime(2022, 1, 20), datetime(2022, 2, 1, 8), datetime(2022, 3, 5), datetime(2022, 3, 31, 23, 59)]


def test_adding_a_month_touches_that_month_only(archive):
    path, rows, read = archive
    write_by_month(rows(*DAYS[:3]), path)
    before = tree(path)
    write_by_month(rows(DAYS[3], datetime(2022, 4, 1), tag="T2"), path)
    after = tree(path)
    old = {name: data for name, data in before.items() if "yymm=2203" not in name}
    assert old and old.items() <= after.items()
    assert not any(name in after for name in before if "yymm=2203" in name)
    assert read() == [(DAYS[0], "T1"), (DAYS[1], "T1"), (DAYS[3], "T2"), (datetime(2022, 4, 1), "T2")]
    write_by_month(rows(DAYS[1], tag="T3"), path, whole=True)
    assert read() == [(DAYS[1], "T3")]
    assert [p.name for p in Path(path).parent.iterdir()] == ["inventory_transaction_archive"]


def test_a_failing_write_or_exchange_leaves_the_history(spark, archive, monkeypatch):
    path, rows, read = archive
    write_by_month(rows(*DAYS), path)
    before, there = tree(path), read()
    with pytest.raises(ArithmeticException, match="DIVIDE_BY_ZERO"):
        write_by_month(rows(*DAYS).selectExpr("* EXCEPT (tag_id)", "CAST(1 / (month(dstamp) - 3) AS STRING) AS tag_id"), path)
    assert tree(path) == before

    plain, calls = Replacement.publish, []

    def third_fails(change):
        calls.append(change)
        if len(calls) == 3:
            raise OSError("no third month")
        plain(change)

    monkeypatch.setattr(files.Replacement, "publish", third_fails)
    with pytest.raises(OSError, match="no third month"):
        write_by_month(rows(*DAYS, tag="T9"), path)
    assert tree(path) == before and read() == there
    assert [p.name for p in Path(path).parent.iterdir()] == ["inventory_transaction_archive"]


def rows_scanned(rows) -> int:
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    return int(plan.collectLeaves().head().metrics().apply("numOutputRows").value())


def test_a_start_inside_a_month_skips_row_groups(spark, archive, settings):
    settings(spark__sql__adaptive__enabled="false", parquet__block__size="4096", parquet__page__size="1024")
    path, rows, _ = archive
    many = spark.range(40_000).selectExpr("timestamp_ntz'2022-03-01 00:00:00' + make_dt_interval(cast(id % 31 as int), cast(id % 24 as int)) AS dstamp", "uuid() AS tag_id")
    empty = rows()
    many = many.selectExpr(*[c if c in many.columns else f"CAST(NULL AS {t}) AS {c}" for c, t in empty.dtypes])
    write_by_month(many, path)
    archive_rows = ParquetTables(spark, str(Path(path).parent))["inventory_transaction_archive"].select("dstamp", "tag_id", "stamp_day", "yymm")
    late = since(archive_rows, date(2022, 3, 29))
    assert late.count() == sum(i % 31 >= 28 for i in range(40_000))
    assert rows_scanned(late) < 12_000
    assert rows_scanned(late.drop("stamp_day")) < 12_000


def test_months_written_without_a_day_column_are_read_whole(spark, archive):
    path, rows, read = archive
    write_by_month(rows(*DAYS[2:]), path)
    rows(datetime(2022, 4, 30)).write.parquet(f"{path}/yymm=2204")
    found = since(ParquetTables(spark, str(Path(path).parent))["inventory_transaction_archive"], date(2022, 3, 31))
    assert sorted(row["dstamp"] for row in found.collect()) == [DAYS[3], datetime(2022, 4, 30)]
