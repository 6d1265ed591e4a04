"""Stock on hand with the zone of its location and the weight of one piece."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from quayside.operators import lookup, named, scope
from quayside.plans.headers import STOCK_WEIGHT


def stock_weight(tables: Mapping[str, DataFrame], site: str, client: str) -> DataFrame:
    """One row per stock row, item and location of that id.

    Location ids are looked up over all sites, so stock in an id that two sites share comes twice.
    """
    stock = scope(tables["inventory"], site_id=site).select("sku_id", "qty_on_hand", "location_id")
    weights = scope(tables["sku"], client_id=client).select("sku_id", "each_weight")
    zones = tables["location"].selectExpr("location_id AS zone_location", "work_zone")
    rows = lookup(stock.join(weights, "sku_id"), zones, {"location_id": "zone_location"})
    return named(rows.select("sku_id", "qty_on_hand", "location_id", "work_zone", "each_weight"), STOCK_WEIGHT)
