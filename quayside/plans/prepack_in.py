"""Receipts of prepacked items with packing material, gate and supplier name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import day, ratio, yyyymm
from quayside.operators import lookup, named, scope
from quayside.plans.headers import PREPACK_IN

LIVE = "inventory_transaction"
ARCHIVE = "inventory_transaction_archive"


def prepack_in(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    conditions: Sequence[str],
    code: str = "Receipt",
    history: Sequence[str] = (LIVE, ARCHIVE),
) -> DataFrame:
    """Each different receipt row of the ``history`` tables once.

    The tables are put together before the joins, not after: the set union of the joined tables
    has the same rows, and items and names are shuffled once. Likewise, repeats among items and
    names are dropped before they multiply receipts.
    """
    receipts = _receipts(tables[history[0]], site, client, conditions, code)
    for name in history[1:]:
        receipts = receipts.union(_receipts(tables[name], site, client, conditions, code))

    properties = scope(tables["v_sku_properties"], client_id=client).filter(F.col("gate_id").isNotNull())
    codes = scope(tables["v_prepack_mat_codes"], site_id=site, client_id=client)
    materials = scope(tables["v_prepack_materials"], site_id=site, client_id=client)
    materials = materials.filter(F.col("sequence_num") == 1)
    names = tables["address"].selectExpr("address_id AS named_id", "name").distinct()

    packed = (
        receipts.join(properties.select("sku_id", "gate_id", "sales_multiple").distinct(), "sku_id")
        .join(codes.select("sku_id", "prepack_code").distinct(), "sku_id")
        .join(materials.select("sku_id", "material_sku_id").distinct(), "sku_id")
    )
    rows = (
        lookup(packed, names, {"supplier_id": "named_id"})
        .select(
            "sku_id",
            "prepack_code",
            "material_sku_id",
            "condition_id",
            "day",
            ratio("update_qty", "sales_multiple").alias("units"),
            "tag_id",
            "gate_id",
            "from_loc_id",
            "supplier_id",
            "name",
        )
        .distinct()
    )
    # The month follows from the day, so it need not take part in the distinct.
    columns = rows.columns
    columns.insert(columns.index("day") + 1, "month")
    return named(rows.withColumn("month", yyyymm("day")).select(*columns), PREPACK_IN)


def prepack_in_live(
    tables: Mapping[str, DataFrame], site: str, client: str, conditions: Sequence[str], code: str = "Receipt"
) -> DataFrame:
    """``prepack_in`` of the current table alone."""
    return prepack_in(tables, site, client, conditions, code, history=(LIVE,))


def prepack_in_archive(
    tables: Mapping[str, DataFrame], site: str, client: str, conditions: Sequence[str], code: str = "Receipt"
) -> DataFrame:
    """``prepack_in`` of the archive alone."""
    return prepack_in(tables, site, client, conditions, code, history=(ARCHIVE,))


def _receipts(moves: DataFrame, site: str, client: str, conditions: Sequence[str], code: str) -> DataFrame:
    return (
        scope(moves, code=code, site_id=site, client_id=client)
        .filter(F.col("condition_id").isin(*conditions))
        .select(
            "sku_id",
            "condition_id",
            day("dstamp").alias("day"),
            "update_qty",
            "tag_id",
            "from_loc_id",
            "supplier_id",
        )
    )
