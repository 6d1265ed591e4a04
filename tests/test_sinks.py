from __future__ import annotations

import csv
import io
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import ArithmeticException, PySparkException

from quayside import jobs
from quayside.plans import headers
from quayside.sinks import snapshot_folder, write_snapshot

SCHEMA = "`Sku ID` string, `Date/hour` string, Value decimal(38,8), Volume double, Day date, Width int"
ROWS = [
    ("plain", "a;b", Decimal("3.75"), 0.25, date(2022, 3, 5), 120),
    ('say "hi"', "a,b", Decimal("12"), 12.0, date(1999, 12, 31), 0),
    ("  spaced  ", "two\nlines", Decimal("0"), 2.0e7, None, None),
    (None, "é€", None, None, date(2022, 3, 5), -1),
    ("#not a comment", "back\\slash", Decimal("-0.5"), 1e-4, date(2022, 3, 5), 7),
]
TEXTS = [
    ["plain", "a;b", "3.75", "0.25", "2022-03-05", "120"],
    ['say "hi"', "a,b", "12", "12.0", "1999-12-31", "0"],
    ["  spaced  ", "two\nlines", "0", "20000000.0", "", ""],
    ["", "é€", "", "", "2022-03-05", "-1"],
    ["#not a comment", "back\\slash", "-0.5", "0.0001", "2022-03-05", "7"],
]


def parts(path) -> list[bytes]:
    return [file.read_bytes() for file in sorted(Path(path).glob("part-*"))]


@pytest.mark.parametrize(("sep", "line_end"), [(";", "\n"), (",", "\n"), (";", "\r\n")])
def test_csv_text(spark, tmp_path, sep, line_end):
    out = f"{tmp_path}/report"
    write_snapshot(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), out, sep, line_end)
    expected = io.StringIO()
    writer = csv.writer(expected, delimiter=sep, lineterminator=line_end)
    writer.writerow(["Sku ID", "Date/hour", "Value", "Volume", "Day", "Width"])
    writer.writerows([[text.replace("\n", line_end) for text in row] for row in TEXTS])
    assert parts(out) == [expected.getvalue().encode()]


def test_snapshot_replaces_the_last_one(spark, tmp_path):
    out = f"{tmp_path}/report"
    write_snapshot(spark.range(1000).repartition(4), out)
    write_snapshot(spark.sql("SELECT 7 AS id"), out)
    assert parts(out) == [b"id\n7\n"]


def test_every_part_has_the_header_and_compact_makes_one_of_few_rows(spark, tmp_path):
    rows = spark.range(1000).repartition(4)
    write_snapshot(rows, f"{tmp_path}/sharded")
    assert [part.splitlines()[0] for part in parts(f"{tmp_path}/sharded")] == [b"id"] * 4
    write_snapshot(rows, f"{tmp_path}/compact", compact=True)
    (one,) = parts(f"{tmp_path}/compact")
    assert one.count(b"\n") == 1001


def test_no_rows_still_give_a_header(spark, table, tmp_path):
    out = str(tmp_path)
    arguments = {"cartons": {"site": "S1", "types": ["71"], "since": date(2022, 1, 1)}}
    jobs.run({"order_container": table("order_container")}, arguments, out)
    assert parts(f"{out}/cartons") == [b"YYMM;DATES;TYPES;STATUS;QTY\n"]


def test_job_writes_each_report_with_its_separator(spark, table, tmp_path):
    tables = {
        "inventory": table("inventory", {"sku_id": "K1", "site_id": "S1", "location_id": "L1", "qty_on_hand": Decimal(2)}),
        "sku": table("sku", {"sku_id": "K1", "client_id": "C1", "each_weight": Decimal("0.5")}),
        "location": table("location"),
        "order_container": table("order_container"),
    }
    settings = {
        "stock_weight": {"site": "S1", "client": "C1"},
        "cartons": {"site": "S1", "types": ["71"], "since": "2022-01-01"},
    }
    jobs.run(tables, jobs.read_arguments(settings), f"{tmp_path}/", compact=True)
    assert parts(f"{tmp_path}/stock_weight") == [b"SKU_ID,QTY_ON_HAND,LOCATION_ID,WORK_ZONE,EACH_WEIGHT\nK1,2,L1,,0.5\n"]
    assert parts(f"{tmp_path}/cartons") == [(";".join(headers.CARTONS) + "\n").encode()]
    with pytest.raises(ValueError, match="no such report: nothing"):
        jobs.run(tables, {"nothing": {}}, str(tmp_path))


@pytest.mark.parametrize("pointer", [False, True])
def test_a_failing_run_leaves_the_last_snapshot(spark, tmp_path, pointer):
    out = f"{tmp_path}/report"
    write_snapshot(spark.sql("SELECT 7 AS id"), out, pointer=pointer)
    before = sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*"))
    with pytest.raises(ArithmeticException, match="DIVIDE_BY_ZERO"):
        write_snapshot(spark.range(10, numPartitions=4).selectExpr("1 / (id - 9) AS id"), out, pointer=pointer)
    assert sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*")) == before
    assert parts(snapshot_folder(spark, out)) == [b"id\n7\n"]


def test_an_ambiguous_dock_leaves_the_last_load_list(spark, table, tmp_path):
    zones = [{"location_id": "D", "site_id": "S1", "loc_type": "ShipDock", "work_zone": zone} for zone in ("DOCK-A", "DOCK-B")]
    here = {"site_id": "S1", "client_id": "C1"}
    tables = {
        "move_task": table("move_task", {**here, "key": 1, "task_id": "O", "line_id": 1, "sku_id": "K", "final_loc_id": "D", "qty_to_move": Decimal(1)}),
        "order_header": table("order_header", {"order_id": "O", "client_id": "C1", "ship_dock": "DOCK1"}),
        "order_line": table("order_line", {"order_id": "O", "line_id": 1}),
        "sku": table("sku", {"sku_id": "K", "client_id": "C1"}),
        "v_sku_properties": table("v_sku_properties", {**here, "sku_id": "K"}),
        **{name: table(name) for name in ("order_container", "consignment_trailer", "v_load_list_items", "pallet_config")},
    }
    arguments = {"loadlist": {"site": "S1", "client": "C1", "loc_type": "ShipDock", "zones": ["DOCK-A"], "excluded_docks": []}}
    jobs.run({**tables, "location": table("location", zones[0])}, arguments, str(tmp_path))
    before = parts(f"{tmp_path}/loadlist")
    assert len(before[-1].splitlines()) == 2
    with pytest.raises(PySparkException, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        jobs.run({**tables, "location": table("location", *zones)}, arguments, str(tmp_path))
    assert parts(f"{tmp_path}/loadlist") == before


def test_runs_behind_a_pointer(spark, tmp_path):
    out = f"{tmp_path}/report"
    for number in range(4):
        write_snapshot(spark.sql(f"SELECT {number} AS id"), out, pointer=True)
        assert parts(snapshot_folder(spark, out)) == [f"id\n{number}\n".encode()]
    assert len([p for p in Path(out).iterdir() if p.name.startswith("run-")]) == 2
    assert snapshot_folder(spark, f"{tmp_path}/other") == f"{tmp_path}/other"


def test_numbers_read_back_equal(spark, tmp_path):
    rows = spark.sql("SELECT id, 1 / pow(7.0D, id) AS small, pow(7.0D, id) AS large, CAST(0.1 AS FLOAT) AS f FROM range(1, 300)")
    write_snapshot(rows, f"{tmp_path}/numbers")
    assert all(b"E" not in part.split(b"\n", 1)[1] for part in parts(f"{tmp_path}/numbers"))
    again = spark.read.schema(rows.schema).csv(f"{tmp_path}/numbers", header=True, sep=";")
    assert sorted(again.collect()) == sorted(rows.collect())
