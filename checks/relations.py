"""Filters, joins, groupings and set unions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import HISTORY, check, history
from quayside.functions import day, yymm
from quayside.operators import (
    keep_listed,
    lookup,
    not_in,
    scope,
    since,
    single_value_lookup,
    union_distinct,
    union_of_sums,
)
from quayside.plans import loadlist_container
from quayside.sample import ARGUMENTS
from quayside.sample.arguments import SINCE

MOVE = ["sku_id", "tag_id", "code", "from_loc_id"]


# --- filters ---------------------------------------------------------------------------------


@check(
    "filter_scope",
    "SELECT sku_id, gate_id FROM v_sku_properties WHERE site_id = 'S1' AND client_id = 'C1'",
)
def filter_scope(tables):
    return scope(tables["v_sku_properties"], site_id="S1", client_id="C1").select("sku_id", "gate_id")


@check("filter_equals", f"SELECT sku_id, tag_id, code, from_loc_id FROM {HISTORY} WHERE code = 'Putaway'")
def filter_equals(tables):
    return scope(history(tables), code="Putaway").select(*MOVE)


@check(
    "filter_in_list",
    f"""SELECT sku_id, tag_id, code, from_loc_id FROM {HISTORY}
        WHERE from_loc_id IN ('TR-1', 'TR-2', 'KIT-1')""",
)
def filter_in_list(tables):
    places = F.col("from_loc_id").isin("TR-1", "TR-2", "KIT-1")
    return history(tables).filter(places).select(*MOVE)


@check(
    "filter_not_in_list",
    "SELECT order_id, ship_dock FROM order_header WHERE ship_dock NOT IN ('SCRAP', 'RETURN')",
)
def filter_not_in_list(tables):
    return tables["order_header"].filter(not_in("ship_dock", ["SCRAP", "RETURN"])).select("order_id", "ship_dock")


@check("filter_not_null", "SELECT sku_id, site_id, gate_id FROM v_sku_properties WHERE gate_id IS NOT NULL")
def filter_not_null(tables):
    return tables["v_sku_properties"].filter(F.col("gate_id").isNotNull()).select("sku_id", "site_id", "gate_id")


@check("filter_null", "SELECT key, status FROM move_task WHERE container_id IS NULL")
def filter_null(tables):
    return tables["move_task"].filter(F.col("container_id").isNull()).select("key", "status")


@check("filter_prefix", f"SELECT reference_id, work_group FROM {HISTORY} WHERE work_group LIKE '800%'")
def filter_prefix(tables):
    return history(tables).filter(F.col("work_group").startswith("800")).select("reference_id", "work_group")


@check(
    "filter_since",
    "SELECT order_id, v_container_type FROM order_container WHERE dstamp >= DATE '1999-01-01'",
)
def filter_since(tables):
    return since(tables["order_container"], SINCE).select("order_id", "v_container_type")


@check(
    "filter_disjunction",
    """SELECT location_id, work_zone FROM location
        WHERE site_id = 'S1' AND loc_type = 'ShipDock' AND (work_zone = 'DOCK-A' OR work_zone = 'DOCK-B')""",
)
def filter_disjunction(tables):
    zone = (F.col("work_zone") == "DOCK-A") | (F.col("work_zone") == "DOCK-B")
    docks = scope(tables["location"], site_id="S1", loc_type="ShipDock").filter(zone)
    return docks.select("location_id", "work_zone")


@check(
    "filter_sequence",
    "SELECT sku_id, material_sku_id FROM v_prepack_materials WHERE sequence_num = 1",
)
def filter_sequence(tables):
    return tables["v_prepack_materials"].filter(F.col("sequence_num") == 1).select("sku_id", "material_sku_id")


# --- joins -----------------------------------------------------------------------------------


@check(
    "join_left_lookup",
    f"""SELECT reference_id, supplier_id, name AS supplier
         FROM {HISTORY} LEFT JOIN address ON address_id = supplier_id""",
)
def join_left_lookup(tables):
    names = tables["address"].select("address_id", F.col("name").alias("supplier"))
    rows = lookup(history(tables), names, {"supplier_id": "address_id"}, keep=["reference_id"])
    return rows.select("reference_id", "supplier_id", "supplier")


@check(
    "join_left_null_rejected",
    """SELECT stock.sku_id, location_id, CAST(each_weight AS DOUBLE) AS each_weight
         FROM inventory AS stock LEFT JOIN sku AS article ON article.sku_id = stock.sku_id
        WHERE article.client_id = 'C1'""",
)
def join_left_null_rejected(tables):
    own = scope(tables["sku"], client_id="C1").select("sku_id", "each_weight")
    return tables["inventory"].join(own, "sku_id").select("sku_id", "location_id", "each_weight")


@check(
    "join_inner_composite",
    """SELECT move.key, line.v_dealer_ord_no, CAST(line.qty_ordered AS DOUBLE) AS qty_ordered
         FROM move_task AS move
         JOIN order_line AS line ON line.order_id = move.task_id AND line.line_id = move.line_id""",
)
def join_inner_composite(tables):
    moves = tables["move_task"].select("key", F.col("task_id").alias("order_id"), "line_id")
    return moves.join(tables["order_line"], ["order_id", "line_id"]).select("key", "v_dealer_ord_no", "qty_ordered")


_BOX_KEYS = {
    "task_id": "order_id",
    "client_id": "box_client",
    "container_id": "box",
    "pallet_id": "box_pallet",
    "site_id": "box_site",
}


def boxes(tables):
    return tables["order_container"].select(
        "order_id",
        F.col("client_id").alias("box_client"),
        F.col("container_id").alias("box"),
        F.col("pallet_id").alias("box_pallet"),
        F.col("v_site_id").alias("box_site"),
        "v_container_type",
        "v_trailer_id",
    )


@check(
    "join_left_composite",
    """SELECT move.key, move.container_id, box.v_container_type
         FROM move_task AS move LEFT JOIN order_container AS box
           ON box.order_id = move.task_id AND box.client_id = move.client_id
          AND box.container_id = move.container_id AND box.pallet_id = move.pallet_id
          AND box.v_site_id = move.site_id""",
)
def join_left_composite(tables):
    rows = lookup(tables["move_task"], boxes(tables), _BOX_KEYS, keep=["key"])
    return rows.select("key", "container_id", "v_container_type")


@check(
    "join_left_plus_single",
    """SELECT move.key, move.pallet_id, list_id
         FROM move_task AS move LEFT JOIN v_load_list_items AS listed ON listed.pallet_id = move.pallet_id""",
)
def join_left_plus_single(tables):
    lists = tables["v_load_list_items"].select(F.col("pallet_id").alias("list_pallet"), "list_id")
    rows = lookup(tables["move_task"], lists, {"pallet_id": "list_pallet"}, keep=["key"])
    return rows.select("key", "pallet_id", "list_id")


_TRIP_SQL = """
       SELECT move.key, box.v_trailer_id, dock_door_id
         FROM move_task AS move {box_join} order_container AS box
           ON box.order_id = move.task_id AND box.client_id = move.client_id
          AND box.container_id = move.container_id AND box.pallet_id = move.pallet_id
          AND box.v_site_id = move.site_id
         JOIN consignment_trailer AS trip
           ON trip.site_id = move.site_id AND trip.consignment = move.consignment
          AND trip.trailer_id = box.v_trailer_id"""


def trailers(tables):
    return tables["consignment_trailer"].withColumnRenamed("trailer_id", "v_trailer_id")


@check("join_outer_cancelled", _TRIP_SQL.format(box_join="LEFT JOIN"))
def join_outer_cancelled(tables):
    # The trailer comes from the box, so a move without a box cannot have one: the outer join
    # to the boxes ends up as an inner one, and Spark sees that by itself.
    moves = lookup(tables["move_task"], boxes(tables), _BOX_KEYS, keep=["key", "consignment"])
    trips = moves.join(trailers(tables), ["site_id", "consignment", "v_trailer_id"])
    return trips.select("key", "v_trailer_id", "dock_door_id")


@check("join_bridge", _TRIP_SQL.format(box_join="JOIN"))
def join_bridge(tables):
    named_boxes = boxes(tables).toDF(
        "task_id", "client_id", "container_id", "pallet_id", "site_id", "v_container_type", "v_trailer_id"
    )
    moves = tables["move_task"].join(named_boxes, ["task_id", "client_id", "container_id", "pallet_id", "site_id"])
    trips = moves.join(trailers(tables), ["site_id", "consignment", "v_trailer_id"])
    return trips.select("key", "v_trailer_id", "dock_door_id")


@check(
    "join_same_dim_twice",
    f"""SELECT reference_id, seller.name AS supplier, buyer.name AS customer
         FROM {HISTORY}
         JOIN address AS seller ON seller.address_id = supplier_id
         JOIN address AS buyer ON buyer.address_id = customer_id""",
)
def join_same_dim_twice(tables):
    sellers = tables["address"].selectExpr("address_id AS supplier_id", "name AS supplier")
    buyers = tables["address"].selectExpr("address_id AS customer_id", "name AS customer")
    rows = history(tables).join(sellers, "supplier_id").join(buyers, "customer_id")
    return rows.select("reference_id", "supplier", "customer")


@check(
    "join_fanout",
    """SELECT stock.sku_id, stock.location_id, place.site_id AS place_site, work_zone
         FROM inventory AS stock LEFT JOIN location AS place ON place.location_id = stock.location_id""",
)
def join_fanout(tables):
    places = tables["location"].selectExpr("location_id AS place", "site_id AS place_site", "work_zone")
    rows = lookup(tables["inventory"], places, {"location_id": "place"}, keep=["sku_id"])
    return rows.select("sku_id", "location_id", "place_site", "work_zone")


@check(
    "join_semi_in",
    """SELECT key, final_loc_id FROM move_task
        WHERE final_loc_id IN (SELECT DISTINCT location_id FROM location
                                WHERE site_id = 'S1' AND loc_type = 'ShipDock')""",
)
def join_semi_in(tables):
    docks = scope(tables["location"], site_id="S1", loc_type="ShipDock").select("location_id")
    return keep_listed(tables["move_task"], "final_loc_id", docks).select("key", "final_loc_id")


@check(
    "join_scalar_lookup",
    """SELECT key, final_loc_id,
              (SELECT DISTINCT work_zone FROM location
                WHERE site_id = 'S1' AND location_id = move.final_loc_id) AS dock_zone
         FROM move_task AS move""",
)
def join_scalar_lookup(tables):
    zones = scope(tables["location"], site_id="S1").select("location_id", F.col("work_zone").alias("dock_zone"))
    moves = tables["move_task"].select("key", "final_loc_id")
    return single_value_lookup(moves, "final_loc_id", zones, "location_id", "dock_zone")


@check(
    "join_star5",
    """SELECT move.key, head.ship_dock, line.user_def_type_1, article.hazmat_id,
              CAST(item.sales_multiple AS DOUBLE) AS sales_multiple
         FROM move_task AS move
         JOIN order_header AS head ON head.client_id = move.client_id AND head.order_id = move.task_id
         JOIN order_line AS line ON line.order_id = move.task_id AND line.line_id = move.line_id
         JOIN sku AS article ON article.sku_id = move.sku_id AND article.client_id = move.client_id
         JOIN v_sku_properties AS item
           ON item.sku_id = move.sku_id AND item.client_id = move.client_id AND item.site_id = move.site_id""",
)
def join_star5(tables):
    rows = (
        tables["move_task"]
        .withColumnRenamed("task_id", "order_id")
        .join(tables["order_header"], ["client_id", "order_id"])
        .join(tables["order_line"], ["order_id", "line_id"])
        .join(tables["sku"], ["sku_id", "client_id"])
        .join(tables["v_sku_properties"], ["sku_id", "client_id", "site_id"])
    )
    return rows.select("key", "ship_dock", "user_def_type_1", "hazmat_id", "sales_multiple")


@check(
    "join_star9",
    """SELECT DISTINCT move.container_id AS "CONTAINER_ID", CAST(move.key AS VARCHAR) AS "Key",
              line.user_def_type_1 AS "CRM Order ID", list_id AS "Load List ID", trip.dock_door_id AS "Dock Door",
              CAST(pallet.weight AS DOUBLE) AS "Tare", article.hazmat_id AS "Hazmat ID",
              CAST(item.sales_multiple AS DOUBLE) AS "Sales Multiple", head.ship_dock AS "Shipdock ID"
         FROM move_task AS move
         JOIN order_header AS head ON head.client_id = move.client_id AND head.order_id = move.task_id
         JOIN order_line AS line ON line.order_id = move.task_id AND line.line_id = move.line_id
         JOIN sku AS article ON article.sku_id = move.sku_id AND article.client_id = move.client_id
         JOIN v_sku_properties AS item
           ON item.sku_id = move.sku_id AND item.client_id = move.client_id AND item.site_id = move.site_id
         JOIN order_container AS box
           ON box.order_id = move.task_id AND box.client_id = move.client_id
          AND box.container_id = move.container_id AND box.pallet_id = move.pallet_id
          AND box.v_site_id = move.site_id
         JOIN consignment_trailer AS trip
           ON trip.site_id = move.site_id AND trip.consignment = move.consignment
          AND trip.trailer_id = box.v_trailer_id
         LEFT JOIN v_load_list_items AS listed ON listed.pallet_id = move.pallet_id
         LEFT JOIN pallet_config AS pallet ON pallet.config_id = box.v_container_type
        WHERE move.site_id = 'S1' AND move.client_id = 'C1' AND head.ship_dock NOT IN ('SCRAP', 'RETURN')
          AND move.final_loc_id IN (SELECT location_id FROM location
                                     WHERE site_id = 'S1' AND loc_type = 'ShipDock'
                                       AND work_zone IN ('DOCK-A', 'DOCK-B'))""",
)
def join_star9(tables):
    rows = loadlist_container(tables, **ARGUMENTS["loadlist_container"])
    columns = ["CONTAINER_ID", "Key", "CRM Order ID", "Load List ID", "Dock Door", "Tare", "Hazmat ID"]
    return rows.select(*columns, "Sales Multiple", "Shipdock ID").distinct()


# --- groupings -------------------------------------------------------------------------------


@check(
    "agg_sum_group",
    f"""SELECT code, sku_id, from_loc_id, CAST(sum(update_qty) AS DOUBLE) AS quantity
         FROM {HISTORY} GROUP BY code, sku_id, from_loc_id""",
)
def agg_sum_group(tables):
    moves = history(tables).groupBy("code", "sku_id", "from_loc_id")
    return moves.agg(F.sum("update_qty").alias("quantity"))


@check(
    "agg_count_group",
    """SELECT v_container_type, v_infoship_status, count(*) AS boxes
         FROM order_container GROUP BY v_container_type, v_infoship_status""",
)
def agg_count_group(tables):
    return tables["order_container"].groupBy("v_container_type", "v_infoship_status").agg(F.count("*").alias("boxes"))


@check(
    "agg_group_expr",
    """SELECT CAST(strftime(dstamp, '%Y%m') AS INTEGER) - 200000 AS yymm, strftime(dstamp, '%Y-%m-%d') AS packed_on,
              count(*) AS boxes
         FROM order_container GROUP BY 1, 2""",
)
def agg_group_expr(tables):
    counts = tables["order_container"].groupBy(yymm("dstamp").alias("yymm"), day("dstamp").alias("packed_on"))
    return counts.agg(F.count("*").alias("boxes"))


@check(
    "agg_group_tuple",
    f"""SELECT code, from_loc_id AS gate, CAST(sum(update_qty) AS DOUBLE) AS quantity
         FROM {HISTORY} GROUP BY GROUPING SETS ((code, from_loc_id))""",
)
def agg_group_tuple(tables):
    # Keys in one pair of parentheses group like the plain list of them.
    moves = history(tables).groupBy("code", F.col("from_loc_id").alias("gate"))
    return moves.agg(F.sum("update_qty").alias("quantity"))


@check(
    "agg_join_then_sum",
    f"""SELECT move.sku_id, gate_id, CAST(sum(update_qty) AS DOUBLE) AS quantity
         FROM {HISTORY} AS move JOIN v_sku_properties AS item ON item.sku_id = move.sku_id
        GROUP BY move.sku_id, gate_id""",
)
def agg_join_then_sum(tables):
    # A quantity counts once per matching item row: the join multiplies the moves, then they are summed.
    items = tables["v_sku_properties"].select("sku_id", "gate_id")
    moves = history(tables).select("sku_id", "update_qty").join(items, "sku_id")
    return moves.groupBy("sku_id", "gate_id").agg(F.sum("update_qty").alias("quantity"))


@check(
    "distinct_rows",
    f"SELECT DISTINCT sku_id, supplier_id, condition_id FROM {HISTORY}",
)
def distinct_rows(tables):
    return history(tables).select("sku_id", "supplier_id", "condition_id").distinct()


@check(
    "distinct_subquery",
    """SELECT order_id, line_id, user_def_type_1 FROM order_line
        WHERE order_id IN (SELECT DISTINCT task_id FROM move_task WHERE container_id IS NULL)""",
)
def distinct_subquery(tables):
    loose = tables["move_task"].filter(F.col("container_id").isNull()).select("task_id")
    return keep_listed(tables["order_line"], "order_id", loose).select("order_id", "line_id", "user_def_type_1")


# --- set unions ------------------------------------------------------------------------------


@check(
    "union_distinct_rows",
    """SELECT sku_id, tag_id, CAST(update_qty AS DOUBLE) AS update_qty FROM inventory_transaction
       UNION
       SELECT sku_id, tag_id, CAST(update_qty AS DOUBLE) FROM inventory_transaction_archive""",
)
def union_distinct_rows(tables):
    columns = ["sku_id", "tag_id", "update_qty"]
    live, archive = tables["inventory_transaction"], tables["inventory_transaction_archive"]
    return union_distinct(live.select(*columns), archive.select(*columns))


@check(
    "union_distinct_aggs",
    """SELECT code, supplier_id, CAST(sum(update_qty) AS DOUBLE) AS quantity
         FROM inventory_transaction GROUP BY code, supplier_id
       UNION
       SELECT code, supplier_id, CAST(sum(update_qty) AS DOUBLE)
         FROM inventory_transaction_archive GROUP BY code, supplier_id""",
)
def union_distinct_aggs(tables):
    live, archive = tables["inventory_transaction"], tables["inventory_transaction_archive"]
    sums = union_of_sums(live, archive, ["code", "supplier_id"], "update_qty")
    return sums.withColumnRenamed("update_qty", "quantity")
