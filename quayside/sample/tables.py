"""The derived tables for Spark, and as common table expressions for DuckDB."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from quayside.sample.views import VIEWS
from quayside.sources import SCHEMAS

BASE = re.compile(r"\b(region|nation|customer|supplier|part|orders|lineitem)\b")


class SampleTables(Mapping[str, DataFrame]):
    """``tables["inventory"]`` derives the named warehouse table from ``<folder>/*.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        """One of the test tables, its schema read once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._opened[name]

    def __getitem__(self, name: str) -> DataFrame:
        used = {table: self.base(table) for table in BASE.findall(VIEWS[name])}
        return self.spark.sql(BASE.sub(r"{\1}", VIEWS[name]), **used).to(SCHEMAS[name])

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def with_views(query: str) -> str:
    """``query`` over warehouse tables as one DuckDB statement over the test tables."""
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items() if re.search(rf"\b{name}\b", query))
    query = query.strip()
    if query.upper().startswith("WITH "):
        return f"WITH {views},\n{query[5:]}"
    return f"WITH {views}\n{query}"
