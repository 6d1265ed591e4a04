"""Projections and scalar functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import HISTORY, check, history
from quayside.functions import day, number_text, parse_day, ratio, run_stamp, time_text, year_month, yymm, yyyymm
from quayside.operators import named, since
from quayside.plans.headers import PREPACK_OUT
from quayside.sample.arguments import AS_OF


@check(
    "project_columns",
    """SELECT stock.sku_id, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, location_id,
              CAST(each_weight AS DOUBLE) AS each_weight
         FROM inventory AS stock JOIN sku USING (sku_id)""",
)
def project_columns(tables):
    stock, weights = tables["inventory"], tables["sku"].select("sku_id", "each_weight")
    return stock.join(weights, "sku_id").select("sku_id", "qty_on_hand", "location_id", "each_weight")


@check(
    "project_alias",
    """SELECT order_id AS "DLX Order ID", ship_dock AS "Shipdock ID", order_type AS "Order Type",
              strftime(ship_by_date, '%Y-%m-%d') AS "Date/Hour"
         FROM order_header WHERE ship_by_date IS NOT NULL""",
)
def project_alias(tables):
    spaced = tables["order_header"].select(
        F.col("order_id").alias("DLX Order ID"),
        F.col("ship_dock").alias("Shipdock ID"),
        F.col("order_type").alias("Order Type"),
        day("ship_by_date").alias("Date/Hour"),
    )
    # A name with a space or a slash is quoted wherever it is used again.
    return spaced.filter("`Date/Hour` IS NOT NULL").select("`DLX Order ID`", "Shipdock ID", "Order Type", "`Date/Hour`")


@check(
    "project_rename_out",
    f"""SELECT strftime(dstamp, '%Y-%m-%d') AS "DATES", move.supplier_id AS "SUPPLIER_ID", seller.name AS "SUPPLIER",
              customer_id AS "CUSTOMER_ID", buyer.name AS "CUSTOMER", move.sku_id AS "SKU_ID",
              reference_id AS "REFERENCE_ID", description AS "DESCRIPTION",
              CAST(standard_cost AS DOUBLE) AS "SCOST", CAST(update_qty AS DOUBLE) AS "QTY",
              v_unit_of_measure AS "UNITES", CAST(v_sales_multiple AS DOUBLE) AS "SALES_QTY",
              container_id AS "CONTAINER_ID"
         FROM {HISTORY} AS move
         JOIN address AS seller ON seller.address_id = move.supplier_id
         JOIN address AS buyer ON buyer.address_id = move.customer_id
         JOIN sku ON sku.sku_id = move.sku_id
         JOIN v_sku_properties AS item ON item.sku_id = move.sku_id""",
)
def project_rename_out(tables):
    moves = history(tables)
    sellers = tables["address"].selectExpr("address_id AS supplier_id", "name AS supplier")
    buyers = tables["address"].selectExpr("address_id AS customer_id", "name AS customer")
    rows = (
        moves.join(sellers, "supplier_id")
        .join(buyers, "customer_id")
        .join(tables["sku"].select("sku_id", "description"), "sku_id")
        .join(tables["v_sku_properties"].select("sku_id", "standard_cost"), "sku_id")
    )
    return named(
        rows.select(
            day("dstamp"),
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
        ),
        PREPACK_OUT,
    )


@check(
    "name_by_position",
    """SELECT location_id AS "FINAL_LOC_ID", work_zone AS "Quai", site_id AS "Work Zone" FROM location""",
)
def name_by_position(tables):
    return named(tables["location"].select("location_id", "work_zone", "site_id"), ["FINAL_LOC_ID", "Quai", "Work Zone"])


@check(
    "project_literal",
    """SELECT 'MT' AS tag, CAST(key AS VARCHAR) AS key FROM move_task WHERE container_id IS NULL
       UNION ALL
       SELECT 'MC', CAST(key AS VARCHAR) FROM move_task WHERE container_id IS NOT NULL""",
)
def project_literal(tables):
    moves = tables["move_task"]
    loose = moves.filter(F.col("container_id").isNull()).select(F.lit("MT").alias("tag"), number_text("key").alias("key"))
    boxed = moves.filter(F.col("container_id").isNotNull()).select(F.lit("MC").alias("tag"), number_text("key").alias("key"))
    return loose.union(boxed)


@check(
    "project_typed_null",
    """SELECT order_id, CAST(NULL AS VARCHAR) AS trailer, CAST(NULL AS DOUBLE) AS weight, CAST(NULL AS INTEGER) AS width
         FROM order_header
       UNION ALL
       SELECT order_id, v_trailer_id, CAST(pallet_weight AS DOUBLE), v_width FROM order_container""",
)
def project_typed_null(tables):
    nulls = tables["order_header"].select(
        "order_id",
        F.lit(None).cast("string").alias("trailer"),
        F.lit(None).cast("decimal(18,4)").alias("weight"),
        F.lit(None).cast("int").alias("width"),
    )
    return nulls.union(tables["order_container"].select("order_id", "v_trailer_id", "pallet_weight", "v_width"))


@check(
    "project_product",
    """SELECT order_id, line_id, CAST(qty_ordered * v_export_line_value AS DOUBLE) AS line_value FROM order_line""",
)
def project_product(tables):
    value = F.col("qty_ordered") * F.col("v_export_line_value")
    return tables["order_line"].select("order_id", "line_id", value.alias("line_value"))


@check(
    "project_quotient",
    f"""SELECT tag_id, move.sku_id, CAST(update_qty AS DOUBLE) / CAST(sales_multiple AS DOUBLE) AS units
         FROM {HISTORY} AS move JOIN v_sku_properties AS item ON item.sku_id = move.sku_id""",
)
def project_quotient(tables):
    rows = history(tables).join(tables["v_sku_properties"].select("sku_id", "sales_multiple"), "sku_id")
    return rows.select("tag_id", "sku_id", ratio("update_qty", "sales_multiple").alias("units"))


@check(
    "project_scale",
    """SELECT container_id, CAST(pallet_volume AS DOUBLE) / 1000 AS volume FROM order_container""",
)
def project_scale(tables):
    return tables["order_container"].select("container_id", ratio("pallet_volume", F.lit(1000)).alias("volume"))


@check("fn_trunc_day", "SELECT key, strftime(dstamp, '%Y-%m-%d') AS moved_on FROM move_task")
def fn_trunc_day(tables):
    return tables["move_task"].select("key", day("dstamp").alias("moved_on"))


@check(
    "fn_year_month",
    """SELECT container_id, CAST(year(dstamp) AS INTEGER) AS year, CAST(month(dstamp) AS INTEGER) AS month
         FROM order_container""",
)
def fn_year_month(tables):
    year, month = year_month("dstamp")
    return tables["order_container"].select("container_id", year.alias("year"), month.alias("month"))


@check("fn_yyyymm", "SELECT key, CAST(strftime(dstamp, '%Y%m') AS INTEGER) AS yyyymm FROM move_task")
def fn_yyyymm(tables):
    return tables["move_task"].select("key", yyyymm("dstamp").alias("yyyymm"))


@check("fn_yymm", "SELECT key, CAST(strftime(dstamp, '%Y%m') AS INTEGER) - 200000 AS yymm FROM move_task")
def fn_yymm(tables):
    return tables["move_task"].select("key", yymm("dstamp").alias("yymm"))


@check("fn_number_to_text", "SELECT CAST(key AS VARCHAR) AS key, task_id FROM move_task")
def fn_number_to_text(tables):
    return tables["move_task"].select(number_text("key").alias("key"), "task_id")


@check("fn_time_text", "SELECT key, strftime(dstamp, '%H:%M:%S') AS moved_at FROM move_task")
def fn_time_text(tables):
    return tables["move_task"].select("key", time_text("dstamp").alias("moved_at"))


@check("fn_run_timestamp", "SELECT order_id, '02/01/2022 08:00:00' AS stamp FROM order_header")
def fn_run_timestamp(tables):
    return tables["order_header"].select("order_id", run_stamp(AS_OF).alias("stamp"))


@check(
    "fn_parse_date",
    """SELECT container_id, strftime(dstamp, '%Y-%m-%d') AS packed_on FROM order_container
        WHERE dstamp >= strptime('01/01/1999', '%d/%m/%Y')""",
)
def fn_parse_date(tables):
    packed = since(tables["order_container"], parse_day("01/01/1999"))
    return packed.select("container_id", day("dstamp").alias("packed_on"))
