"""Derivation of the warehouse tables from the test tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations


def _transactions(quantity: str, period: str) -> str:
    return f"""
  SELECT CAST(l_partkey AS STRING) AS sku_id,
         CASE l_returnflag WHEN 'R' THEN 'Receipt' WHEN 'A' THEN 'Putaway' WHEN 'N' THEN 'Shipment' END AS code,
         CASE WHEN l_linenumber = 6 THEN 'S2' ELSE 'S1' END AS site_id,
         CASE WHEN l_discount = CAST(0.1 AS DOUBLE) THEN 'C2' ELSE 'C1' END AS client_id,
         CASE WHEN l_linestatus = 'O' THEN 'PPACK' WHEN l_linenumber IN (1, 3) THEN 'KIT' ELSE 'STD' END
           AS condition_id,
         l_shipdate + l_linenumber * INTERVAL '1' HOUR AS dstamp,
         CAST({quantity} AS DECIMAL(18,4)) AS update_qty,
         'T' || (l_orderkey % 500) AS tag_id,
         CASE WHEN l_linenumber <= 3 THEN 'TR-' || l_linenumber WHEN l_linenumber = 4 THEN 'KIT-1' ELSE 'BULK' END
           AS from_loc_id,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE 'S' || l_suppkey END AS supplier_id,
         'C' || o_custkey AS customer_id,
         CAST(l_orderkey AS STRING) AS reference_id,
         (CASE WHEN o_orderpriority < '3' THEN '800' ELSE '700' END) || l_linenumber AS work_group,
         CASE WHEN o_orderstatus = 'F' THEN 'SHP-A' ELSE 'SHP-B' END AS consignment,
         'CT' || l_orderkey || '-' || l_linenumber AS container_id,
         'EA' AS v_unit_of_measure,
         CAST(l_linenumber AS DECIMAL(18,4)) AS v_sales_multiple
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
   WHERE l_shipdate + l_linenumber * INTERVAL '1' HOUR {period}"""


VIEWS: dict[str, str] = {
    "inventory_transaction": _transactions("l_quantity", ">= DATE '2000-06-01'"),
    "inventory_transaction_archive": _transactions(
        "CASE WHEN l_quantity > 45 THEN l_quantity + 1 ELSE l_quantity END", "< DATE '2000-07-15'"
    ),
    "v_sku_properties": """
  SELECT CAST(p_partkey AS STRING) AS sku_id, 'S1' AS site_id, 'C1' AS client_id,
         CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN 'E3' WHEN 2 THEN 'H9' ELSE 'G1' END AS gate_id,
         CAST(p_size % 4 + 1 AS DECIMAL(18,4)) AS sales_multiple,
         CAST(p_retailprice AS DECIMAL(18,4)) AS standard_cost
    FROM part
  UNION ALL
  SELECT CAST(p_partkey AS STRING), 'S2', 'C1', 'E3', CAST(2 AS DECIMAL(18,4)), CAST(p_retailprice AS DECIMAL(18,4))
    FROM part WHERE p_size <= 10""",
    "v_prepack_mat_codes": """
  SELECT CAST(p_partkey AS STRING) AS sku_id, CASE p_size % 2 WHEN 0 THEN 'S1' ELSE 'S2' END AS site_id,
         'C1' AS client_id, 'PK' || p_size AS prepack_code
    FROM part""",
    "v_prepack_materials": """
  SELECT CAST(p_partkey AS STRING) AS sku_id, 'S1' AS site_id, 'C1' AS client_id, 1 AS sequence_num,
         'M' || p_size AS material_sku_id
    FROM part
  UNION ALL
  SELECT CAST(p_partkey AS STRING), 'S1', 'C1', 2, 'M' || (p_size * 2) FROM part""",
    "address": """
  SELECT (CASE WHEN s_nationkey = 0 THEN 'XS' ELSE 'S' END) || s_suppkey AS address_id, 'C1' AS client_id,
         s_name AS name
    FROM supplier
  UNION ALL
  SELECT 'S' || s_suppkey, 'C2', s_name || ' bis' FROM supplier WHERE s_nationkey = 1
  UNION ALL
  SELECT (CASE WHEN c_nationkey = 0 THEN 'XC' ELSE 'C' END) || c_custkey, 'C1', c_name FROM customer""",
    "sku": """
  SELECT CAST(p_partkey AS STRING) AS sku_id, CASE WHEN p_size = 50 THEN 'C2' ELSE 'C1' END AS client_id,
         p_name AS description, CAST(CAST(p_size AS DOUBLE) / 10 AS DECIMAL(18,4)) AS each_weight,
         CAST(CAST(p_size AS DOUBLE) / 100 AS DECIMAL(18,4)) AS each_volume,
         CASE WHEN p_type = 'PROMO' THEN 'HZ1' END AS hazmat_id
    FROM part""",
    "inventory": """
  SELECT CAST(l_partkey AS STRING) AS sku_id,
         CASE WHEN l_linestatus = 'O' AND l_linenumber <> 6 THEN 'S1' ELSE 'S2' END AS site_id,
         'L' || l_suppkey AS location_id, CAST(l_quantity AS DECIMAL(18,4)) AS qty_on_hand
    FROM lineitem""",
    "location": """
  SELECT (CASE WHEN s_suppkey % 10 = 9 THEN 'X' ELSE 'L' END) || s_suppkey AS location_id, 'S1' AS site_id,
         CASE WHEN s_suppkey % 2 = 0 THEN 'ShipDock' ELSE 'Bin' END AS loc_type,
         CASE s_suppkey % 3 WHEN 0 THEN 'DOCK-A' WHEN 1 THEN 'DOCK-B' ELSE 'BULK' END AS work_zone
    FROM supplier
  UNION ALL
  SELECT 'L' || s_suppkey, 'S2', 'Bin', 'REMOTE' FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL
  SELECT 'TR-' || r_regionkey, 'S1', 'Transit', CASE WHEN r_regionkey <= 2 THEN 'RECEIVE' ELSE 'REPACK' END
    FROM region""",
    "order_header": """
  SELECT CAST(o_orderkey AS STRING) AS order_id, 'C1' AS client_id,
         o_orderdate + INTERVAL '30' HOUR AS ship_by_date,
         CASE o_orderpriority WHEN '5-LOW' THEN 'SCRAP' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'DOCK1' END
           AS ship_dock,
         o_orderpriority AS order_type, CASE o_orderstatus WHEN 'P' THEN 'Y' ELSE 'N' END AS user_def_chk_6
    FROM orders""",
    "order_line": """
  SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS line_id,
         'CRM' || l_orderkey AS user_def_type_1, l_linenumber AS user_def_num_3,
         'D' || l_orderkey AS v_dealer_ord_no, l_linenumber AS v_dealer_ord_line_no,
         CAST(l_quantity AS DECIMAL(18,4)) AS qty_ordered,
         CAST(l_extendedprice AS DECIMAL(18,4)) AS v_export_line_value, 'EUR' AS user_def_type_3
    FROM lineitem""",
    "move_task": """
  SELECT l_orderkey * 10 + l_linenumber AS key, CASE l_linestatus WHEN 'O' THEN 'S1' ELSE 'S2' END AS site_id,
         'C1' AS client_id, CAST(l_orderkey AS STRING) AS task_id, l_linenumber AS line_id,
         CAST(l_partkey AS STRING) AS sku_id, 'C' || (l_orderkey % 1500) AS customer_id,
         l_shipdate + l_linenumber * INTERVAL '1' HOUR AS dstamp,
         CAST(l_quantity AS DECIMAL(18,4)) AS qty_to_move,
         CASE l_returnflag WHEN 'N' THEN 'Released' ELSE 'Hold' END AS status, 'WZ1' AS work_zone,
         'P' || (l_orderkey % 300) AS pallet_id, '8001' AS work_group,
         'CS' || (l_orderkey % 20) AS consignment, 'L' || (l_partkey % 100) AS from_loc_id,
         'STAGE' AS to_loc_id, 'L' || l_suppkey AS final_loc_id,
         CASE l_returnflag WHEN 'N' THEN NULL ELSE 'CT' || l_orderkey END AS container_id
    FROM lineitem""",
    "order_container": """
  SELECT CAST(o_orderkey AS STRING) AS order_id, 'C1' AS client_id, 'CT' || o_orderkey AS container_id,
         'P' || (o_orderkey % 300) AS pallet_id, CASE o_orderkey % 3 WHEN 0 THEN 'S2' ELSE 'S1' END AS v_site_id,
         o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS dstamp,
         '7' || (o_custkey % 8) AS v_container_type,
         CASE o_orderstatus WHEN 'F' THEN 'Sent' ELSE 'Open' END AS v_infoship_status,
         CAST(o_orderkey % 90 AS DECIMAL(18,4)) AS pallet_weight,
         CAST(o_orderkey % 700 AS DECIMAL(18,4)) AS pallet_volume, 'CAR' AS v_carrier_id,
         CASE o_orderkey % 7 WHEN 0 THEN NULL ELSE 'TRL' || (o_orderkey % 20) END AS v_trailer_id,
         'STD' AS v_service_level, 'ROAD' AS v_dispatch_method, 120 AS v_width, 80 AS v_height, 100 AS v_depth
    FROM orders""",
    "v_load_list_items": """
  SELECT 'P' || (n_nationkey * 10) AS pallet_id, 'LL' || n_nationkey AS list_id FROM nation""",
    "consignment_trailer": """
  SELECT 'S1' AS site_id, 'CS' || n_nationkey AS consignment, 'TRL' || n_nationkey AS trailer_id,
         'D' || n_regionkey AS dock_door_id
    FROM nation""",
    "pallet_config": """
  SELECT '7' || r_regionkey AS config_id, CAST(r_regionkey + 1 AS DECIMAL(18,4)) AS weight FROM region""",
}
