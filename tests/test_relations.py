"""Queries of ``checks/relations.py`` on rows of their own."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest

from checks import relations


@pytest.fixture
def moved(table):
    """Moves and items: copies on both sides, a gate that is NULL, keys and quantities that are NULL, keys without a match."""
    return {
        "inventory_transaction": table(
            "inventory_transaction",
            {"sku_id": "A", "update_qty": Decimal("1.5")},
            {"sku_id": "A", "update_qty": Decimal("1.5")},
            {"sku_id": "A", "update_qty": None},
            {"sku_id": "B", "update_qty": None},
            {"sku_id": None, "update_qty": Decimal(7)},
            {"sku_id": "no item", "update_qty": Decimal(7)},
        ),
        "inventory_transaction_archive": table(
            "inventory_transaction_archive",
            {"sku_id": "A", "update_qty": Decimal("1.5")},
            {"sku_id": "C", "update_qty": Decimal(-2)},
        ),
        "v_sku_properties": table(
            "v_sku_properties",
            {"sku_id": "A", "site_id": "S1", "gate_id": "E3"},
            {"sku_id": "A", "site_id": "S1", "gate_id": "E3"},
            {"sku_id": "A", "site_id": "S2", "gate_id": "H9"},
            {"sku_id": "A", "site_id": "S3", "gate_id": None},
            {"sku_id": "B", "site_id": "S1", "gate_id": "E3"},
            {"sku_id": "C", "site_id": "S1", "gate_id": None},
            {"sku_id": "C", "site_id": "S2", "gate_id": None},
            {"sku_id": None, "site_id": "S1", "gate_id": "E3"},
            {"sku_id": "no move", "site_id": "S1", "gate_id": "E3"},
        ),
    }


def test_agg_join_then_sum_joins_first(moved):
    plan = relations.agg_join_then_sum(moved)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"\b(Aggregate|Join)\b", plan) == ["Aggregate", "Join"]


def test_agg_join_then_sum_counts_a_move_per_item_row(moved):
    rows = relations.agg_join_then_sum(moved)
    assert rows.columns == ["sku_id", "gate_id", "quantity"]
    assert sorted(map(tuple, rows.collect()), key=repr) == [
        ("A", "E3", Decimal(9)),
        ("A", "H9", Decimal("4.5")),
        ("A", None, Decimal("4.5")),
        ("B", "E3", None),
        ("C", None, Decimal(-4)),
    ]
