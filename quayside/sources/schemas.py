"""Columns the reports read, per warehouse table, and the check that a source delivers them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
AMOUNT = T.DecimalType(18, 4)
COUNT = T.IntegerType()
NUMBER = T.LongType()
MOMENT = T.TimestampNTZType()  # the warehouse keeps local date-times without a zone


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TRANSACTION = _table(
    sku_id=TEXT,
    code=TEXT,
    site_id=TEXT,
    client_id=TEXT,
    condition_id=TEXT,
    dstamp=MOMENT,
    update_qty=AMOUNT,
    tag_id=TEXT,
    from_loc_id=TEXT,
    supplier_id=TEXT,
    customer_id=TEXT,
    reference_id=TEXT,
    work_group=TEXT,
    consignment=TEXT,
    container_id=TEXT,
    v_unit_of_measure=TEXT,
    v_sales_multiple=AMOUNT,
)

SCHEMAS: dict[str, T.StructType] = {
    "inventory_transaction": _TRANSACTION,
    "inventory_transaction_archive": _TRANSACTION,
    "v_sku_properties": _table(
        sku_id=TEXT, site_id=TEXT, client_id=TEXT, gate_id=TEXT, sales_multiple=AMOUNT, standard_cost=AMOUNT
    ),
    "v_prepack_mat_codes": _table(sku_id=TEXT, site_id=TEXT, client_id=TEXT, prepack_code=TEXT),
    "v_prepack_materials": _table(
        sku_id=TEXT, site_id=TEXT, client_id=TEXT, sequence_num=COUNT, material_sku_id=TEXT
    ),
    "address": _table(address_id=TEXT, client_id=TEXT, name=TEXT),
    "sku": _table(
        sku_id=TEXT, client_id=TEXT, description=TEXT, each_weight=AMOUNT, each_volume=AMOUNT, hazmat_id=TEXT
    ),
    "inventory": _table(sku_id=TEXT, site_id=TEXT, location_id=TEXT, qty_on_hand=AMOUNT),
    "location": _table(location_id=TEXT, site_id=TEXT, loc_type=TEXT, work_zone=TEXT),
    "move_task": _table(
        key=NUMBER,
        site_id=TEXT,
        client_id=TEXT,
        task_id=TEXT,
        line_id=COUNT,
        sku_id=TEXT,
        customer_id=TEXT,
        dstamp=MOMENT,
        qty_to_move=AMOUNT,
        status=TEXT,
        work_zone=TEXT,
        pallet_id=TEXT,
        work_group=TEXT,
        consignment=TEXT,
        from_loc_id=TEXT,
        to_loc_id=TEXT,
        final_loc_id=TEXT,
        container_id=TEXT,
    ),
    "order_header": _table(
        order_id=TEXT, client_id=TEXT, ship_by_date=MOMENT, ship_dock=TEXT, order_type=TEXT, user_def_chk_6=TEXT
    ),
    "order_line": _table(
        order_id=TEXT,
        line_id=COUNT,
        user_def_type_1=TEXT,
        user_def_num_3=COUNT,
        v_dealer_ord_no=TEXT,
        v_dealer_ord_line_no=COUNT,
        qty_ordered=AMOUNT,
        v_export_line_value=AMOUNT,
        user_def_type_3=TEXT,
    ),
    "order_container": _table(
        order_id=TEXT,
        client_id=TEXT,
        container_id=TEXT,
        pallet_id=TEXT,
        v_site_id=TEXT,
        dstamp=MOMENT,
        v_container_type=TEXT,
        v_infoship_status=TEXT,
        pallet_weight=AMOUNT,
        pallet_volume=AMOUNT,
        v_carrier_id=TEXT,
        v_trailer_id=TEXT,
        v_service_level=TEXT,
        v_dispatch_method=TEXT,
        v_width=COUNT,
        v_height=COUNT,
        v_depth=COUNT,
    ),
    "v_load_list_items": _table(pallet_id=TEXT, list_id=TEXT),
    "consignment_trailer": _table(site_id=TEXT, consignment=TEXT, trailer_id=TEXT, dock_door_id=TEXT),
    "pallet_config": _table(config_id=TEXT, weight=AMOUNT),
}

_MOMENTS = (T.TimestampType, T.TimestampNTZType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)  # from narrow to wide
_ANY_WHOLE = T.DecimalType(20, 0)  # holds every bigint


def conform(rows: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of the named table in declared order, plus the ``keep`` columns if there.

    No value changes. Decimals and floating-point numbers keep the type they arrive in, whatever
    their scale; whole numbers are only widened. Both kinds of date-time pass as they are, so
    filters on them still reach the scan. Any other type than the declared kind is an error before
    any job, so is a declared whole number that may arrive with a fraction.
    """
    arrived = {field.name.lower(): field for field in rows.schema}
    columns = []
    for wanted in SCHEMAS[name]:
        field = arrived.get(wanted.name)
        if field is None:
            raise ValueError(f"{name} has no column {wanted.name}")
        kind = _kind(field.dataType, wanted.dataType)
        if kind is None:
            raise ValueError(
                f"{name}.{wanted.name} is {field.dataType.simpleString()}, "
                f"expected {wanted.dataType.simpleString()}"
            )
        column = F.col(field.name)
        columns.append((column if kind == field.dataType else column.cast(kind)).alias(wanted.name))
    extra = [F.col(column) for column in keep if column in rows.columns]
    return rows.select(*columns, *extra)


def _kind(arrived: T.DataType, wanted: T.DataType) -> T.DataType | None:
    """The type a column is read in: that it has, or a wider one; None if it is no fit."""
    if arrived == wanted:
        return arrived
    if isinstance(wanted, _MOMENTS):
        return arrived if isinstance(arrived, _MOMENTS) else None
    if wanted == AMOUNT:
        return _ANY_WHOLE if isinstance(arrived, _WHOLE) else arrived if isinstance(arrived, T.FractionalType) else None
    if isinstance(wanted, _WHOLE):
        if isinstance(arrived, _WHOLE):
            return max(arrived, wanted, key=lambda kind: _WHOLE.index(type(kind)))
        return arrived if isinstance(arrived, T.DecimalType) and arrived.scale == 0 else None
    return None
