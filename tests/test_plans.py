"""What the reports' plans look like on stored tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from checks import relations
from quayside import plans
from quayside.plans import REPORTS
from quayside.sample import ARGUMENTS, SampleTables
from quayside.sources import SCHEMAS, ParquetTables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    sample = SampleTables(spark, FOLDER)
    for name in SCHEMAS:
        sample[name].write.parquet(f"{root}/{name}")
    return ParquetTables(spark, str(root))


def build(stored, name):
    return getattr(plans, name)(stored, **ARGUMENTS[name])


def optimized(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def physical(rows) -> str:
    mode = rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return rows._jdf.queryExecution().explainString(mode)


def join_types(rows) -> list[str]:
    return sorted(re.findall(r"Join (\w+)", optimized(rows)))


@pytest.mark.parametrize(
    ("name", "inner", "outer"),
    [
        ("prepack_in", 3, 1),
        ("prepack_out", 4, 0),
        ("gate_putaway", 1, 0),
        ("offload", 0, 0),
        ("cartons", 0, 0),
        ("stock_weight", 1, 1),
        ("loadlist_open", 5, 0),
        # The trailer condition turns the joins to boxes and trailers into inner ones.
        ("loadlist_container", 7, 2),
        ("loadlist", 5, 4),
    ],
)
def test_join_types(stored, name, inner, outer):
    assert join_types(build(stored, name)) == ["Inner"] * inner + ["LeftOuter"] * outer


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_no_cross_join_no_single_task(stored, name):
    plan = physical(build(stored, name))
    for word in ("Python", "Pandas", "Cartesian", "NestedLoop", "SinglePartition"):
        assert word not in plan, word


@pytest.mark.parametrize("name", REPORTS)
def test_the_main_table_is_shuffled_for_groupings_only(stored, name):
    """With join sides small enough to broadcast, as here."""
    node = build(stored, name)._jdf.queryExecution().executedPlan().initialPlan()
    shuffles = 0
    while node.children().nonEmpty():
        shuffles += node.nodeName() == "Exchange"
        node = node.children().head()
    assert node.nodeName().startswith("Scan parquet")
    assert shuffles == {"stock_weight": 0}.get(name, 1)


def scans(rows) -> dict[str, str]:
    """Description of the scan per table."""
    found = {}
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\n)", physical(rows), flags=re.S):
        table = re.search(r"Location: .*?\[.*?/(\w+)\]", block)[1]
        found[table] = block
    return found


def read_columns(block: str) -> set[str]:
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", block)[1]))


def test_scans_take_over_filters_and_columns(stored):
    found = scans(build(stored, "cartons"))
    assert read_columns(found["order_container"]) == {"v_site_id", "dstamp", "v_container_type", "v_infoship_status"}
    pushed = re.search(r"PushedFilters: \[(.*)\]", found["order_container"])[1]
    for part in ("EqualTo(v_site_id,S1)", "In(v_container_type, [71,72,73,74])", "GreaterThanOrEqual(dstamp,"):
        assert part in pushed

    found = scans(build(stored, "prepack_out"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", found["inventory_transaction"])[1]
    for part in ("EqualTo(code,Shipment)", "EqualTo(site_id,S1)", "EqualTo(client_id,C1)", "StringStartsWith(work_group,800)"):
        assert part in pushed
    assert read_columns(found["v_sku_properties"]) == {"sku_id", "site_id", "client_id", "standard_cost"}


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("join_left_lookup", {"inventory_transaction": {"reference_id", "supplier_id"}, "address": {"address_id", "name"}}),
        (
            "join_left_composite",
            {
                "move_task": {"key", "task_id", "client_id", "container_id", "pallet_id", "site_id"},
                "order_container": {"order_id", "client_id", "container_id", "pallet_id", "v_site_id", "v_container_type"},
            },
        ),
        ("join_left_plus_single", {"move_task": {"key", "pallet_id"}, "v_load_list_items": {"pallet_id", "list_id"}}),
        ("join_outer_cancelled", {"move_task": {"key", "consignment", "task_id", "client_id", "container_id", "pallet_id", "site_id"}}),
        ("join_fanout", {"inventory": {"sku_id", "location_id"}, "location": {"location_id", "site_id", "work_zone"}}),
    ],
)
def test_a_lookup_reads_keys_and_wanted_columns_only(stored, name, columns):
    found = scans(getattr(relations, name)(stored))
    assert {table: read_columns(found[table]) for table in columns} == columns


def test_the_load_list_reads_each_table_once(stored):
    plan = physical(build(stored, "loadlist"))
    tables = re.findall(r"Location: .*?\[.*?/(\w+)\]", plan)
    assert sorted(tables) == sorted(set(tables)) and len(tables) == 10


def test_results_are_the_same_without_broadcasts(stored, settings):
    expected = {name: build(stored, name).collect() for name in ("prepack_in", "loadlist", "stock_weight")}
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    for name, rows in expected.items():
        again = build(stored, name).collect()
        assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
