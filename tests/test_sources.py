from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import since
from quayside.session import prepare, scratch
from quayside.sources import SCHEMAS, JdbcTables, ParquetTables, Split, conform, write_by_month

MOVE = {"sku_id": "K1", "dstamp": datetime(2022, 3, 5, 12), "update_qty": Decimal("1.5"), "tag_id": "T1"}


def test_all_sixteen_tables_have_a_schema():
    assert len(SCHEMAS) == 16
    assert SCHEMAS["inventory_transaction"] == SCHEMAS["inventory_transaction_archive"]


def test_parquet_tables_round_trip(spark, table, tmp_path):
    rows = table("inventory_transaction", MOVE)
    rows.write.parquet(f"{tmp_path}/inventory_transaction")
    got = ParquetTables(spark, str(tmp_path))["inventory_transaction"]
    assert got.schema == rows.schema
    assert got.collect() == rows.collect()
    with pytest.raises(KeyError):
        ParquetTables(spark, str(tmp_path))["no_such_table"]


def test_conform_orders_columns(spark):
    rows = spark.sql("SELECT 5 AS weight, 'x' AS extra, 'C' AS CONFIG_ID")
    got = conform(rows, "pallet_config")
    assert got.dtypes == [("config_id", "string"), ("weight", "decimal(20,0)")]
    assert got.first() == ("C", Decimal(5))


@pytest.mark.parametrize(
    ("value", "kind"),
    [("CAST(0.000045 AS DECIMAL(18,6))", "decimal(18,6)"), ("1e-9D", "double"), ("CAST(0.1 AS FLOAT)", "float"), ("CAST(7 AS DECIMAL(38,10))", "decimal(38,10)")],
)
def test_conform_rounds_nothing(spark, value, kind):
    rows = spark.sql(f"SELECT 'C' AS config_id, {value} AS weight")
    got = conform(rows, "pallet_config")
    assert got.dtypes[1] == ("weight", kind)
    assert got.first() == rows.first()


def test_whole_numbers_are_widened_only_and_come_without_fractions(spark):
    base = "SELECT 'K' AS sku_id, 'S1' AS site_id, 'C1' AS client_id, {} AS sequence_num, 'M' AS material_sku_id"
    for value, kind in [("1S", "int"), ("1", "int"), ("1L", "bigint"), ("CAST(1 AS DECIMAL(38,0))", "decimal(38,0)")]:
        got = conform(spark.sql(base.format(value)), "v_prepack_materials")
        assert dict(got.dtypes)["sequence_num"] == kind
        assert got.filter("sequence_num = 1").count() == 1
    for value in ("1.9", "1.9D", "CAST(1 AS DECIMAL(38,10))"):
        with pytest.raises(ValueError, match="sequence_num is .*expected int"):
            conform(spark.sql(base.format(value)), "v_prepack_materials")


def test_products_of_wide_decimals_keep_their_places(spark):
    row = spark.sql("SELECT CAST(0.0000000003 AS DECIMAL(38,10)) * CAST(0.5 AS DECIMAL(38,10)) AS product").first()
    assert row["product"] == Decimal("1.5e-10")


def test_conform_rejects_wrong_types_and_missing_columns(spark):
    with pytest.raises(ValueError, match="pallet_config has no column weight"):
        conform(spark.sql("SELECT 'C' AS config_id"), "pallet_config")
    with pytest.raises(ValueError, match="weight is string, expected decimal"):
        conform(spark.sql("SELECT 'C' AS config_id, '5' AS weight"), "pallet_config")


def test_conform_takes_both_kinds_of_moments(spark, table):
    zoned = table("inventory_transaction", MOVE).withColumn("dstamp", F.col("dstamp").cast("timestamp"))
    assert dict(conform(zoned, "inventory_transaction").dtypes)["dstamp"] == "timestamp"


def test_blanks_become_null_on_request(spark, table, tmp_path):
    table("address", {"address_id": "A", "client_id": "", "name": " "}).write.parquet(f"{tmp_path}/address")
    assert ParquetTables(spark, str(tmp_path))["address"].first() == ("A", "", " ")
    assert ParquetTables(spark, str(tmp_path), blank_is_null=True)["address"].first() == ("A", None, " ")


def test_history_by_month_skips_old_folders(spark, table, tmp_path):
    moments = [datetime(2021, 12, 31, 23, 59), datetime(2022, 1, 1), datetime(2022, 1, 20), datetime(2022, 3, 1)]
    rows = table("inventory_transaction_archive", *({**MOVE, "dstamp": moment} for moment in moments))
    path = f"{tmp_path}/inventory_transaction_archive"
    write_by_month(rows, path)
    archive = ParquetTables(spark, str(tmp_path))["inventory_transaction_archive"]
    recent = since(archive, date(2022, 1, 10))
    assert sorted(row["dstamp"] for row in recent.collect()) == moments[2:]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "yymm" in partition_filters and "2201" in partition_filters


JDBC = {"url": "jdbc:oracle:thin:@//host/service", "user": "reader"}


def test_jdbc_options(spark):
    tables = JdbcTables(spark, JDBC, "wms", {"inventory": Split("qty_on_hand", "0", "100", 8)})
    options = tables.options("inventory")
    assert options == {
        "url": "jdbc:oracle:thin:@//host/service",
        "user": "reader",
        "fetchsize": "10000",
        "dbtable": "wms.inventory",
        "customSchema": "sku_id string, site_id string, location_id string",
        "partitionColumn": "qty_on_hand",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "8",
    }
    assert "partitionColumn" not in tables.options("location")
    assert tables.query_options("SELECT 1 FROM dual")["query"] == "SELECT 1 FROM dual"
    assert list(tables) == list(SCHEMAS) and len(tables) == 16


def test_a_growing_table_is_not_read_over_one_connection(spark):
    for name in set(SCHEMAS) - {"location", "pallet_config"}:
        with pytest.raises(ValueError, match=f"{name} needs a Split"):
            JdbcTables(spark, JDBC).options(name)
    with pytest.raises(KeyError):
        JdbcTables(spark, JDBC).options("no_such_table")


def test_custom_schema_is_valid_ddl(spark):
    for name, schema in SCHEMAS.items():
        ddl = JdbcTables(spark, JDBC, splits={name: Split("x", "0", "1", 2)}).options(name)["customSchema"]
        rows = spark.createDataFrame([], ddl)
        asked = {field.name for field in schema if not isinstance(field.dataType, T.NumericType)}
        assert set(rows.columns) == asked
        numbers = {column: F.lit(1).cast("decimal(38,0)") for column in schema.names if column not in asked}
        assert conform(rows.withColumns(numbers), name).columns == schema.names


def test_a_date_time_filter_can_be_written_for_the_database(spark):
    ddl = JdbcTables(spark, JDBC, splits={"move_task": Split("key", "0", "1", 2)}).options("move_task")["customSchema"]
    assert "dstamp timestamp" in ddl
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(JDBC["url"])
    assert dialect.compileValue(jvm.java.sql.Timestamp.valueOf("2022-01-01 00:00:00")) == "{ts '2022-01-01 00:00:00.0'}"


def test_jdbc_needs_one_zone(spark, settings):
    settings(spark__sql__session__timeZone="Asia/Kolkata")
    with pytest.raises(RuntimeError, match="user.timezone"):
        JdbcTables(spark, JDBC).check_zone()


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")


def test_prepare_leaves_chosen_settings_alone(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="1MB", spark__sql__ansi__enabled="false")
    prepare(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1MB"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_a_history_is_cut_by_its_size_before_it_is_written(table, tmp_path, monkeypatch):
    from quayside.sources import parquet

    cut = []
    monkeypatch.setattr(parquet, "size_shuffles", lambda rows: cut.append(rows.columns[-1]))
    parquet.write_by_month(table("inventory_transaction", {"dstamp": datetime(2022, 3, 1), "sku_id": "1"}), f"{tmp_path}/history")
    assert cut == ["stamp_day"]


def test_all_tables_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    """Each write waits until all sixteen have begun."""
    import threading

    from pyspark.sql import DataFrameWriter
    from checks import storage

    class Tables(dict):
        pass

    tables = Tables((name, spark.createDataFrame([], schema)) for name, schema in SCHEMAS.items())
    tables.spark = spark
    together, plain = threading.Barrier(len(SCHEMAS), timeout=60), DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (together.wait(), plain(self, path))[1])
    found = storage.scan_table(tables).collect()
    assert sorted((row["name"], row["n_rows"]) for row in found) == sorted((name, 0) for name in SCHEMAS)
