"""Shipments of prepacked items with supplier, customer and item data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import day
from quayside.operators import named, scope
from quayside.plans.headers import PREPACK_OUT


def prepack_out(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    work_group_prefix: str,
    consignment: str,
    include_archive: bool = False,
    code: str = "Shipment",
) -> DataFrame:
    """Each different shipment row once; a shipment lacking any of the joined data is left out.

    Repeats among the joined rows are dropped before they multiply shipments.
    """
    shipments = _shipments(tables["inventory_transaction"], site, client, work_group_prefix, consignment, code)
    if include_archive:
        archive = tables["inventory_transaction_archive"]
        shipments = shipments.union(_shipments(archive, site, client, work_group_prefix, consignment, code))

    items = scope(tables["sku"], client_id=client).select("sku_id", "description").distinct()
    costs = scope(tables["v_sku_properties"], site_id=site, client_id=client).select("sku_id", "standard_cost").distinct()
    parties = scope(tables["address"], client_id=client).select("address_id", "name").distinct()
    suppliers = parties.selectExpr("address_id AS supplier_id", "name AS supplier")
    customers = parties.selectExpr("address_id AS customer_id", "name AS customer")

    rows = (
        shipments.join(items, "sku_id")
        .join(costs, "sku_id")
        .join(suppliers, "supplier_id")
        .join(customers, "customer_id")
        .select(
            "day",
            "supplier_id",
            "supplier",
            "customer_id",
            "customer",
            "sku_id",
            "reference_id",
            "description",
            "standard_cost",
            "update_qty",
            "v_unit_of_measure",
            "v_sales_multiple",
            "container_id",
        )
        .distinct()
    )
    return named(rows, PREPACK_OUT)


def _shipments(
    moves: DataFrame, site: str, client: str, work_group_prefix: str, consignment: str, code: str
) -> DataFrame:
    return (
        scope(moves, code=code, site_id=site, client_id=client, consignment=consignment)
        .filter(F.col("work_group").startswith(work_group_prefix))
        .select(
            day("dstamp").alias("day"),
            "supplier_id",
            "customer_id",
            "sku_id",
            "reference_id",
            "update_qty",
            "v_unit_of_measure",
            "v_sales_multiple",
            "container_id",
        )
    )
