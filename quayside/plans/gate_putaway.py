"""Quantity put away per month, item, place it came from and gate of the item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import yymm
from quayside.operators import named, scope, union_of_sums
from quayside.operators import since as stamped_since
from quayside.plans.headers import GATE_PUTAWAY


def gate_putaway(
    tables: Mapping[str, DataFrame],
    site: str,
    gates: Sequence[str],
    from_locs: Sequence[str],
    since: date,
    code: str = "Putaway",
) -> DataFrame:
    """Sums over current and archived moves, as a set union of the two.

    Items are matched over all sites and clients, and a move counts once per matching item row.
    So the sum per gate is the plain sum times the number of item rows with that gate: both
    sides are grouped before they are joined, and rows are never multiplied out.
    """

    def moves(name: str) -> DataFrame:
        rows = stamped_since(scope(tables[name], site_id=site, code=code), since)
        rows = rows.filter(F.col("from_loc_id").isin(*from_locs))
        return rows.select(yymm("dstamp").alias("yymm"), "sku_id", "from_loc_id", "update_qty")

    sums = union_of_sums(
        moves("inventory_transaction"),
        moves("inventory_transaction_archive"),
        ["yymm", "sku_id", "from_loc_id"],
        "update_qty",
    )
    gated = (
        tables["v_sku_properties"]
        .filter(F.col("gate_id").isin(*gates))
        .groupBy("sku_id", "gate_id")
        .agg(F.count("*").alias("item_rows"))
    )
    per_gate = F.col("update_qty") * F.col("item_rows")
    rows = sums.join(gated, "sku_id").select(
        "yymm", F.lit(code), "sku_id", per_gate, "from_loc_id", "gate_id"
    )
    return named(rows, GATE_PUTAWAY)
