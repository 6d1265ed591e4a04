"""Warehouse tables in the operational database, read over JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.schemas import MOMENT, SCHEMAS, TEXT, conform

# Tables with a row per place or pallet type. All others grow with the business, and one connection
# must not read such a table whole.
SMALL = ("location", "pallet_config")


@dataclass(frozen=True)
class Split:
    """Cut of a table into ``parts`` equal ranges of a number, date or date-time column.

    The bounds only place the cuts: the first and last range are open, no row is left out. Spark
    writes date-time bounds as plain text; a database that needs them in another format can be
    told so with the connection option ``sessionInitStatement``. Numbers need nothing.
    """

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class JdbcTables(Mapping[str, DataFrame]):
    """``tables["inventory"]`` scans ``<schema>.inventory``; Spark hands filters and columns down.

    ``connection`` holds the JDBC options for url, driver, user and password. ``splits`` names
    the cut per table and must cover each table in use that is not one of ``SMALL``.

    Numbers come in the database's own types, so none is rounded; a whole number must be declared
    as one there (a view may do that), else it is rejected.

    Date-times are read as instants: not every dialect can filter on zone-less ones. The driver
    reads them in the zone of the JVM, so that has to be the session's: start driver and
    executors with ``-Duser.timezone=UTC``.
    """

    spark: SparkSession
    connection: Mapping[str, str]
    schema: str = ""
    splits: Mapping[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, name: str) -> dict[str, str]:
        """JDBC reader options for one table."""
        if name not in SCHEMAS:
            raise KeyError(name)
        if name not in SMALL and name not in self.splits:
            raise ValueError(f"{name} needs a Split to be read in parallel")
        types = ", ".join(
            f"{column.name} {'timestamp' if column.dataType == MOMENT else column.dataType.simpleString()}"
            for column in SCHEMAS[name]
            if column.dataType in (TEXT, MOMENT)
        )
        cut = self.splits[name].options() if name in self.splits else {}
        table = f"{self.schema}.{name}" if self.schema else name
        return {**self._common(), **cut, "dbtable": table, "customSchema": types}

    def query_options(self, statement: str) -> dict[str, str]:
        """JDBC reader options for a statement the database runs itself."""
        return {**self._common(), "query": statement}

    def query(self, statement: str) -> DataFrame:
        """Result of a whole statement run by the database.

        It arrives over one connection: for small results only, scans are the default.
        """
        return self.spark.read.format("jdbc").options(**self.query_options(statement)).load()

    def _common(self) -> dict[str, str]:
        return {**self.connection, "fetchsize": str(self.fetch_size)}

    def check_zone(self) -> None:
        """Fail if date-times would be read in another zone than the session's."""
        time = self.spark._jvm.java
        session = time.time.ZoneId.of(self.spark.conf.get("spark.sql.session.timeZone"))
        machine = time.util.TimeZone.getDefault().toZoneId()
        if not session.getRules().equals(machine.getRules()):
            raise RuntimeError(f"the JVM runs in zone {machine}, the session in {session}: set -Duser.timezone")

    def __getitem__(self, name: str) -> DataFrame:
        if MOMENT in (column.dataType for column in SCHEMAS[name]):
            self.check_zone()
        return conform(self.spark.read.format("jdbc").options(**self.options(name)).load(), name)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)
