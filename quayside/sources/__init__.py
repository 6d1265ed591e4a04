"""The warehouse tables and the places they are read from."""

from quayside.sources.bucketed import BucketedTables, enough_buckets, write_by_order
from quayside.sources.jdbc import JdbcTables, Split
from quayside.sources.parquet import ParquetTables, write_by_month
from quayside.sources.schemas import SCHEMAS, conform

__all__ = ["SCHEMAS", "BucketedTables", "JdbcTables", "ParquetTables", "Split", "conform", "enough_buckets", "write_by_month", "write_by_order"]
