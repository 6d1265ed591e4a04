"""Sources and sinks: written to a new scratch folder, read back, compared with the plain table.

Reading over JDBC has no query here: it needs a database that all executors can reach.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import check
from checks.reports import CARTONS_SQL, STOCK_WEIGHT_SQL, offload_sql, report, with_archive
from quayside import jobs
from quayside.functions import ratio
from quayside.operators import since, union_distinct
from quayside.sample import ARGUMENTS
from quayside.sample.arguments import SINCE
from quayside.session import input_bytes, scratch, size_shuffles
from quayside.sinks import write_snapshot
from quayside.sources import SCHEMAS, ParquetTables, write_by_month


def read_back(spark: SparkSession, path: str, sep: str, like: DataFrame) -> DataFrame:
    """A snapshot with the column types of the frame it was written from."""
    return spark.read.schema(like.schema).csv(path, header=True, sep=sep, escape='"', nullValue="")


def _text(name: str, kind: T.DataType) -> str:
    """A column's value as text that both engines write alike, in DuckDB's SQL."""
    if isinstance(kind, T.DecimalType):
        return f"CAST(CAST({name} AS DECIMAL(18, 4)) AS VARCHAR)"
    if isinstance(kind, T.StringType):
        return name
    return f"CAST({name} AS VARCHAR)" if isinstance(kind, T.NumericType) else f"strftime({name}, '%Y-%m-%d %H:%M:%S')"


def _row_sql(schema: T.StructType) -> str:
    return " || '|' || ".join(f"coalesce('=' || {_text(field.name, field.dataType)}, '-')" for field in schema)


# A row's digest changes with any value in it and with values that change places; their sum does not depend on order.
SCAN_SQL = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS name, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5({_row_sql(schema)}), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM {table}"
    for table, schema in SCHEMAS.items()
)


def row_digest(schema: T.StructType) -> Column:
    """The digest of a row, as in ``SCAN_SQL``."""
    parts = []
    for field in schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("decimal(18, 4)")
        elif not isinstance(field.dataType, (T.StringType, T.NumericType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        parts.append(F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


@check("scan_table", SCAN_SQL)
def scan_table(tables):
    root = scratch(tables.spark, "tables")
    stored = ParquetTables(tables.spark, root)
    derived = {name: tables[name] for name in SCHEMAS}
    size_shuffles(max(derived.values(), key=input_bytes))
    # All at once, as small tables and the last tasks of large ones leave cores idle.
    with ThreadPoolExecutor(len(derived)) as writers:
        list(writers.map(lambda name: derived[name].write.parquet(f"{root}/{name}"), derived))
    found = []
    for name, schema in SCHEMAS.items():
        sums = [F.count("*").alias("n_rows"), F.sum(row_digest(schema)).alias("digest")]
        found.append(stored[name].agg(*sums).select(F.lit(name).alias("name"), "n_rows", "digest"))
    return reduce(DataFrame.unionAll, found)


@check(
    "scan_live_archive",
    """SELECT sku_id, tag_id, code, strftime(dstamp, '%Y-%m-%d %H:%M:%S') AS moved, CAST(update_qty AS DOUBLE) AS update_qty
         FROM inventory_transaction WHERE dstamp >= DATE '1999-01-01'
       UNION
       SELECT sku_id, tag_id, code, strftime(dstamp, '%Y-%m-%d %H:%M:%S'), CAST(update_qty AS DOUBLE)
         FROM inventory_transaction_archive WHERE dstamp >= DATE '1999-01-01'""",
)
def scan_live_archive(tables):
    root = scratch(tables.spark, "history")
    live = tables["inventory_transaction"]
    size_shuffles(live)
    live.write.parquet(f"{root}/inventory_transaction")
    archive = tables["inventory_transaction_archive"]
    old = F.col("dstamp") < F.lit(date(1998, 1, 1))
    write_by_month(archive.where(old), f"{root}/inventory_transaction_archive")
    write_by_month(archive.where(~old), f"{root}/inventory_transaction_archive")  # later months are added
    stored = ParquetTables(tables.spark, root)
    live, archive = (
        since(stored[name], SINCE).select(
            "sku_id", "tag_id", "code", F.col("dstamp").cast("string").alias("moved"), "update_qty"
        )
        for name in ("inventory_transaction", "inventory_transaction_archive")
    )
    return union_distinct(live, archive)


@check("sink_csv_semicolon", with_archive(offload_sql))
def sink_csv_semicolon(tables):
    path, rows = scratch(tables.spark, "offload"), report("offload", tables)
    write_snapshot(rows, path, sep=";")
    return read_back(tables.spark, path, ";", rows)


@check("sink_csv_comma", STOCK_WEIGHT_SQL)
def sink_csv_comma(tables):
    path, rows = scratch(tables.spark, "stock_weight"), report("stock_weight", tables)
    write_snapshot(rows, path, sep=",")
    return read_back(tables.spark, path, ",", rows)


@check(
    "sink_small_quotients",
    """SELECT order_id, line_id, 1 / CAST(v_export_line_value AS DOUBLE) AS share, CAST(qty_ordered AS DOUBLE) * 1e15 AS grains
         FROM order_line""",
)
def sink_small_quotients(tables):
    """Quotients under a thousandth and products beyond exponents read back as the same numbers."""
    grains = F.col("qty_ordered").cast("double") * F.lit(1e15)
    rows = tables["order_line"].select("order_id", "line_id", ratio(F.lit(1), "v_export_line_value").alias("share"), grains.alias("grains"))
    path = scratch(tables.spark, "quotients")
    write_snapshot(rows, path)
    return read_back(tables.spark, path, ";", rows)


@check("sink_snapshot", CARTONS_SQL)
def sink_snapshot(tables):
    path, rows = scratch(tables.spark, "cartons"), report("cartons", tables)
    write_snapshot(report("cartons", tables, types=["70", "75"]), path)
    write_snapshot(rows, path)
    return read_back(tables.spark, path, ";", rows)


@check(
    "multi_output_job",
    f"""SELECT 'offload' AS report, "YYMM" AS month, "SKU_ID" AS item, "UPDATE_QTY" AS amount
         FROM ({with_archive(offload_sql)})
       UNION ALL
       SELECT 'cartons', "YYMM", "TYPES", CAST("QTY" AS DOUBLE) FROM ({CARTONS_SQL})""",
)
def multi_output_job(tables):
    out = scratch(tables.spark, "reports")
    jobs.run(tables, {name: ARGUMENTS[name] for name in ("offload", "cartons")}, out)
    offload = read_back(tables.spark, f"{out}/offload", ";", report("offload", tables))
    cartons = read_back(tables.spark, f"{out}/cartons", ";", report("cartons", tables))
    return offload.select(
        F.lit("offload").alias("report"),
        F.col("YYMM").alias("month"),
        F.col("SKU_ID").alias("item"),
        F.col("UPDATE_QTY").cast("double").alias("amount"),
    ).union(cartons.select(F.lit("cartons"), "YYMM", "TYPES", F.col("QTY").cast("double")))


@check(
    "empty_result",
    """SELECT 'YYMM;DATES;TYPES;STATUS;QTY' AS line
       UNION
       SELECT v_container_type FROM order_container WHERE dstamp >= DATE '2100-01-01'""",
)
def empty_result(tables):
    path = scratch(tables.spark, "empty")
    write_snapshot(report("cartons", tables, since=date(2100, 1, 1)), path)
    return tables.spark.read.text(path).select(F.col("value").alias("line")).distinct()
