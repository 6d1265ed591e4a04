"""Open moves to the shipping docks, with and without container.

Each different row counts once. Copies in the small tables, which would multiply every move, are dropped
before those are joined; the moves and the large order tables are left as they are, as grouping them
first would shuffle each once more, and the last step drops what is left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import day, number_text, ratio, run_stamp, time_text
from quayside.operators import checked_value, lookup, named, not_in, scope, single_value
from quayside.plans.headers import LOADLIST

# Tags of the two kinds of moves.
OPEN_TAG = "MT"
CONTAINER_TAG = "MC"

# What its container, trailer, load list and pallet type add to a move.
CONTAINER_COLUMNS = {
    "v_container_type": "string",
    "pallet_weight": "decimal(18,4)",
    "pallet_volume": "decimal(18,4)",
    "v_carrier_id": "string",
    "v_trailer_id": "string",
    "v_service_level": "string",
    "v_dispatch_method": "string",
    "v_width": "int",
    "v_height": "int",
    "v_depth": "int",
    "dock_door_id": "string",
    "list_id": "string",
    "tare": "decimal(18,4)",
}


def loadlist(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    loc_type: str,
    zones: Sequence[str],
    excluded_docks: Sequence[str],
    as_of: datetime | None = None,
) -> DataFrame:
    """Moves without container (tag MT) and with container (tag MC), each different row once.

    Both kinds go through the same outer joins: a move without container finds nothing and keeps
    NULLs, a move whose container or trailer is missing is dropped afterwards. So the tables are
    read once, not once per kind.
    """
    moves = _dock_moves(tables, site, client, loc_type, zones, excluded_docks)
    packed = _with_containers(moves, tables, site, client, keep_open=True)
    return _finished(_with_items(packed, tables, site, client), as_of)


def loadlist_open(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    loc_type: str,
    zones: Sequence[str],
    excluded_docks: Sequence[str],
    as_of: datetime | None = None,
) -> DataFrame:
    """Moves without container alone; what a container would add is NULL."""
    moves = _dock_moves(tables, site, client, loc_type, zones, excluded_docks)
    nulls = {name: F.lit(None).cast(kind) for name, kind in CONTAINER_COLUMNS.items()}
    loose = moves.filter(F.col("container_id").isNull()).withColumns(nulls)
    return _finished(_with_items(loose, tables, site, client), as_of)


def loadlist_container(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    loc_type: str,
    zones: Sequence[str],
    excluded_docks: Sequence[str],
    as_of: datetime | None = None,
) -> DataFrame:
    """Moves with container alone."""
    moves = _dock_moves(tables, site, client, loc_type, zones, excluded_docks)
    packed = _with_containers(moves.filter(F.col("container_id").isNotNull()), tables, site, client, keep_open=False)
    return _finished(_with_items(packed, tables, site, client), as_of)


def _dock_moves(
    tables: Mapping[str, DataFrame],
    site: str,
    client: str,
    loc_type: str,
    zones: Sequence[str],
    excluded_docks: Sequence[str],
) -> DataFrame:
    """Moves that end at a dock of the zones, with their order.

    The joins that drop moves come first, those that multiply them (``_with_items``) last.
    """
    moves = scope(tables["move_task"], site_id=site, client_id=client).select(
        "container_id",
        "key",
        "customer_id",
        F.col("task_id").alias("order_id"),
        "line_id",
        "dstamp",
        "sku_id",
        "qty_to_move",
        "status",
        "work_zone",
        "pallet_id",
        "work_group",
        "consignment",
        "from_loc_id",
        "to_loc_id",
        "final_loc_id",
    )
    places = scope(tables["location"], site_id=site).select(
        "site_id", F.col("location_id").alias("final_loc_id"), F.col("work_zone").alias("dock_zone"), "loc_type"
    )
    is_dock = (F.col("loc_type") == loc_type) & F.col("dock_zone").isin(*zones)
    # Grouped by place, one table answers both questions: is this a dock, and what is its zone.
    # Grouping by site as well makes the join shuffle the docks by place anew, so that Spark can
    # split the moves of a busy dock.
    summary = single_value(places, ["site_id", "final_loc_id"], "dock_zone", F.bool_or(is_dock).alias("is_dock"))
    docks = summary.filter("is_dock").select("final_loc_id", "dock_zone", "ambiguous")
    orders = scope(tables["order_header"], client_id=client).filter(not_in("ship_dock", excluded_docks))
    orders = orders.select("order_id", "ship_by_date", "ship_dock", "order_type", "user_def_chk_6")
    return moves.join(docks, "final_loc_id").join(orders, "order_id")


def _with_containers(
    moves: DataFrame, tables: Mapping[str, DataFrame], site: str, client: str, keep_open: bool
) -> DataFrame:
    """Add ``CONTAINER_COLUMNS``; a move lacking container or trailer stays only if it is open."""
    boxes = scope(tables["order_container"], v_site_id=site, client_id=client).select(
        F.col("order_id").alias("box_order"),
        F.col("container_id").alias("box"),
        F.col("pallet_id").alias("box_pallet"),
        "v_container_type",
        "pallet_weight",
        "pallet_volume",
        "v_carrier_id",
        "v_trailer_id",
        "v_service_level",
        "v_dispatch_method",
        "v_width",
        "v_height",
        "v_depth",
    )
    trailers = scope(tables["consignment_trailer"], site_id=site).select(
        F.col("consignment").alias("trailer_consignment"), F.col("trailer_id").alias("trailer"), "dock_door_id"
    )
    lists = tables["v_load_list_items"].select(F.col("pallet_id").alias("list_pallet"), "list_id")
    tares = tables["pallet_config"].select("config_id", F.col("weight").alias("tare"))

    # Moves have an order by now. Where tables lie by order (``BucketedTables``), boxes join without a shuffle.
    by_order = getattr(tables, "by_order", False)
    rows = lookup(moves, boxes, {"order_id": "box_order", "container_id": "box", "pallet_id": "box_pallet"}, aligned=by_order)
    rows = lookup(rows, trailers.distinct(), {"consignment": "trailer_consignment", "v_trailer_id": "trailer"})
    on_trailer = F.col("trailer").isNotNull()
    rows = rows.filter(F.col("container_id").isNull() | on_trailer if keep_open else on_trailer)
    packed_pallet = F.when(F.col("container_id").isNotNull(), F.col("pallet_id"))
    rows = lookup(rows.withColumn("packed_pallet", packed_pallet), lists.distinct(), {"packed_pallet": "list_pallet"})
    return lookup(rows, tares.distinct(), {"v_container_type": "config_id"})


def _with_items(moves: DataFrame, tables: Mapping[str, DataFrame], site: str, client: str) -> DataFrame:
    """Add order line and item."""
    lines = tables["order_line"].select(
        "order_id",
        "line_id",
        "user_def_type_1",
        "user_def_num_3",
        "v_dealer_ord_no",
        "v_dealer_ord_line_no",
        "qty_ordered",
        "v_export_line_value",
        "user_def_type_3",
    )
    items = scope(tables["sku"], client_id=client).select("sku_id", "each_weight", "each_volume", "hazmat_id")
    properties = scope(tables["v_sku_properties"], site_id=site, client_id=client).select("sku_id", "sales_multiple")
    return moves.join(lines, ["order_id", "line_id"]).join(items.distinct(), "sku_id").join(properties.distinct(), "sku_id")


def _finished(rows: DataFrame, as_of: datetime | None) -> DataFrame:
    """The report's columns, each different row once, under the report's header."""
    columns = rows.select(
        "container_id",
        F.when(F.col("container_id").isNull(), F.lit(OPEN_TAG)).otherwise(F.lit(CONTAINER_TAG)).alias("tag"),
        number_text("key").alias("key"),
        "customer_id",
        "order_id",
        "line_id",
        "user_def_type_1",
        "user_def_num_3",
        "v_dealer_ord_no",
        "v_dealer_ord_line_no",
        day("dstamp").alias("moved_on"),
        time_text("dstamp").alias("moved_at"),
        day("ship_by_date").alias("ship_by"),
        "sku_id",
        "qty_ordered",
        "qty_to_move",
        "sales_multiple",
        "list_id",
        "user_def_chk_6",
        "status",
        "work_zone",
        "pallet_id",
        "work_group",
        "consignment",
        "from_loc_id",
        "to_loc_id",
        "order_type",
        "v_container_type",
        "pallet_weight",
        ratio("pallet_volume", F.lit(1000)).alias("volume"),
        "v_carrier_id",
        "v_trailer_id",
        "v_service_level",
        "v_dispatch_method",
        "v_width",
        "v_height",
        "v_depth",
        (F.col("qty_to_move") * F.col("v_export_line_value")).alias("value"),
        "user_def_type_3",
        "hazmat_id",
        "dock_door_id",
        "ship_dock",
        (F.col("qty_to_move") * F.col("each_weight")).alias("net_weight"),
        "each_weight",
        "each_volume",
        "tare",
        "final_loc_id",
        checked_value("final_loc_id", "dock_zone").alias("quai"),
    )
    # The run stamp is one constant: added last, it is not shuffled.
    return named(columns.distinct().withColumn("stamp", run_stamp(as_of)), LOADLIST)
