"""Registry of the queries and the form in which results are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sample import SampleTables, with_views
from quayside.session import prepare, size_shuffles

#: Both history tables as one, as long as they are, the rows of their overlap in both versions.
HISTORY = "(SELECT * FROM inventory_transaction UNION ALL SELECT * FROM inventory_transaction_archive)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str):
    """Register a function of the sample tables under ``name``, with SQL over the same tables."""

    def register(build: Callable[[SampleTables], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = comparable(build(SampleTables(prepare(spark), sf_dir)))
            size_shuffles(rows)
            return rows

        QUERIES[name] = query
        ORACLES[name] = with_views(sql)
        return build

    return register


def history(tables: SampleTables) -> DataFrame:
    """The rows of ``HISTORY``."""
    return tables["inventory_transaction"].unionAll(tables["inventory_transaction_archive"])


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and days as text: the two engines hand those to Python differently.

    The SQL side casts the same columns itself.
    """
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return rows.select(*columns)
