"""Warehouse tables as parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.files import Folder, Replacement, publish_all
from quayside.functions import yymm
from quayside.operators.filters import DAY, MONTH_FOLDER
from quayside.session import size_shuffles
from quayside.sources.schemas import SCHEMAS, conform


class ParquetTables(Mapping[str, DataFrame]):
    """``tables["inventory"]`` reads ``<root>/inventory``; a table nobody asks for is not opened.

    A history table may be laid out in month folders (``write_by_month``). ``blank_is_null`` is
    for files filled from text exports, where a missing text is ``''``; it keeps text filters
    from the scan, so rather clean such files once when they land.
    """

    def __init__(self, spark: SparkSession, root: str, blank_is_null: bool = False):
        self._spark = spark
        self._root = root.rstrip("/")
        self._blank_is_null = blank_is_null

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(name)
        rows = conform(self._spark.read.parquet(f"{self._root}/{name}"), name, keep=(MONTH_FOLDER, DAY))
        return blanks_to_null(rows) if self._blank_is_null else rows

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def blanks_to_null(rows: DataFrame) -> DataFrame:
    """Empty text as NULL, in all text columns."""
    texts = [field.name for field in rows.schema if isinstance(field.dataType, T.StringType)]
    return rows.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


def write_by_month(rows: DataFrame, path: str, stamp: str = "dstamp", whole: bool = False) -> None:
    """Put the months of ``rows`` into a history table that has one folder per month, so that ``since`` skips old folders whole.

    Months that ``rows`` has are replaced, the others stay untouched; with ``whole`` they go, and the table is what ``rows``
    are. All rows are written aside first and months exchanged once that has succeeded, each by renaming: a failing write, or a failing
    exchange, leaves the history as it was. For a moment of the exchange a reader can miss a month.

    The rebalance hint gathers each month into files of the advisory partition size; a month
    too big for one task is split over several. Within a file, rows are in the order of their day, which is a column with
    statistics (date-times have none that Spark uses): a start inside a month skips row groups.
    """
    files = Folder(rows.sparkSession, path)
    new = Folder(rows.sparkSession, files.beside(f"new-{uuid.uuid4().hex}"))
    dated = rows.withColumns({MONTH_FOLDER: yymm(stamp), DAY: F.to_date(stamp)}).hint("rebalance", MONTH_FOLDER)
    size_shuffles(dated)
    try:
        dated.sortWithinPartitions(MONTH_FOLDER, DAY).write.partitionBy(MONTH_FOLDER).parquet(new.path)
        months = [child.name for child in new.children() if child.name.startswith(f"{MONTH_FOLDER}=")]
        changes = [Replacement(files, files.child(month), new.child(month)) for month in months]
        if whole:
            gone = (c.name for c in files.children() if c.name.startswith(f"{MONTH_FOLDER}=") and c.name not in months)
            changes += [Replacement(files, files.child(month), None) for month in gone]
        files.create()
        publish_all(changes)
    finally:
        new.delete(new.path)
