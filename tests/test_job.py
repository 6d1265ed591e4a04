from __future__ import annotations

import json
import sys
from decimal import Decimal
from pathlib import Path

import pytest

from quayside import __main__ as command
from quayside import plans
from quayside.sources import JdbcTables, Split


@pytest.fixture
def settings_file(table, tmp_path):
    table("inventory", {"sku_id": "K1", "site_id": "S1", "location_id": "L1", "qty_on_hand": Decimal(2)}).write.parquet(
        f"{tmp_path}/tables/inventory"
    )
    table("sku", {"sku_id": "K1", "client_id": "C1"}).write.parquet(f"{tmp_path}/tables/sku")
    table("location").write.parquet(f"{tmp_path}/tables/location")
    settings = {
        "tables": {"parquet": f"{tmp_path}/tables"},
        "out": f"{tmp_path}/out",
        "reports": {
            "stock_weight": {"site": "S1", "client": "C1"},
            "cartons": {"site": "S1", "types": ["71"], "since": "2022-01-01"},
        },
    }
    file = tmp_path / "settings.json"
    file.write_text(json.dumps(settings))
    return file


def test_command_runs_the_named_reports(spark, settings_file, tmp_path, monkeypatch):
    monkeypatch.setattr(sys, "argv", ["quayside", str(settings_file), "stock_weight", "--compact"])
    command.main()
    (part,) = Path(f"{tmp_path}/out/stock_weight").glob("part-*")
    assert part.read_text() == "SKU_ID,QTY_ON_HAND,LOCATION_ID,WORK_ZONE,EACH_WEIGHT\nK1,2,L1,,\n"
    assert not Path(f"{tmp_path}/out/cartons").exists()


def test_blank_text_counts_as_null_where_the_settings_say_so(spark, table, tmp_path):
    """A move whose container id is blank is one without container."""
    here = {"site_id": "S1", "client_id": "C1"}
    moved = {**here, "key": 1, "task_id": "O", "line_id": 1, "sku_id": "K", "final_loc_id": "D", "qty_to_move": Decimal(1), "container_id": ""}
    rows = {
        "move_task": moved,
        "location": {"location_id": "D", "site_id": "S1", "loc_type": "ShipDock", "work_zone": "Z"},
        "order_header": {"order_id": "O", "client_id": "C1", "ship_dock": "DOCK1"},
        "order_line": {"order_id": "O", "line_id": 1},
        "sku": {"sku_id": "K", "client_id": "C1"},
        "v_sku_properties": {**here, "sku_id": "K"},
    }
    for name, row in rows.items():
        table(name, row).write.parquet(f"{tmp_path}/{name}")
    for name in ("order_container", "consignment_trailer", "v_load_list_items", "pallet_config"):
        table(name).write.parquet(f"{tmp_path}/{name}")
    arguments = {"site": "S1", "client": "C1", "loc_type": "ShipDock", "zones": ["Z"], "excluded_docks": []}
    kinds = []
    for blank in (False, True):
        tables = command.open_tables(spark, {"parquet": str(tmp_path), "blank_is_null": blank}, None)
        kinds.append([row["Table"] for row in plans.loadlist(tables, **arguments).collect()])
    assert kinds == [[], ["MT"]]


def test_database_settings(spark, monkeypatch):
    monkeypatch.setenv("WMS_PASSWORD", "secret")
    source = {
        "jdbc": {
            "connection": {"url": "jdbc:x", "user": "reader"},
            "schema": "wms",
            "splits": {"move_task": {"column": "key", "lower": "0", "upper": "1000000", "parts": 64}},
        }
    }
    tables = command.open_tables(spark, source, "WMS_PASSWORD")
    assert isinstance(tables, JdbcTables)
    assert tables.splits == {"move_task": Split("key", "0", "1000000", 64)}
    options = tables.options("move_task")
    assert options["password"] == "secret" and options["dbtable"] == "wms.move_task"
