"""The tables that the load list joins by order, stored in buckets by order id."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import input_bytes, shuffle_cuts, size_shuffles
from quayside.sources.schemas import SCHEMAS, conform

#: The column of each table that holds the order id.
ORDER_IDS = {"move_task": "task_id", "order_header": "order_id", "order_line": "order_id", "order_container": "order_id"}


#: Unpacked bytes of input, as Spark estimates them, that a bucket of the largest table may come from.
BUCKET_BYTES = 32 << 20
#: Spark's own limit, ``spark.sql.sources.bucketing.maxBuckets``.
MOST_BUCKETS = 100_000


def enough_buckets(tables: Mapping[str, DataFrame], least: int = 8) -> int:
    """As many buckets as the largest table of ``ORDER_IDS`` needs for each to stay small, whatever its size.

    A bucket is read and sorted by one task. Sizes are those of the scans; for inputs of unknown size (a database) choose yourself.
    """
    return min(MOST_BUCKETS, shuffle_cuts(max(input_bytes(tables[name]) for name in ORDER_IDS), BUCKET_BYTES, least))


def write_by_order(tables: Mapping[str, DataFrame], database: str, root: str, buckets: int, most: float = 4.0) -> None:
    """Store the tables of ``ORDER_IDS`` under ``root`` as tables of ``database`` with ``buckets`` files each, by order id.

    One shuffle when they are stored saves one per join and run. A bucket is read by one task and Spark cannot split it, so
    a table whose largest bucket has over ``most`` times the rows of the mean one (a hot order) is an error before
    any is written: leave such tables as they are, where joins do split hot orders.
    """
    for name, key in ORDER_IDS.items():
        sizes = tables[name].groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).count()
        largest, rows = sizes.agg(F.max("count"), F.sum("count")).first()
        if rows and largest > most * max(1, rows / buckets) and largest > MANY:
            raise ValueError(f"{name}: one of {buckets} buckets would hold {largest} of {rows} rows")
    for name, key in ORDER_IDS.items():
        rows = tables[name]
        size_shuffles(rows)
        stored = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
        stored.option("path", f"{root.rstrip('/')}/{name}").mode("overwrite").saveAsTable(f"{database}.{name}")


#: Buckets of so few rows are no burden, however uneven.
MANY = 100_000


class BucketedTables(Mapping[str, DataFrame]):
    """``ORDER_IDS`` from ``database`` as ``write_by_order`` stored them, all other tables from ``others``.

    The joins by order then need no shuffle of these tables. For that the session must take rows with equal order ids
    in one task as good enough for a join by order and line.
    """

    by_order = True

    def __init__(self, spark: SparkSession, database: str, others: Mapping[str, DataFrame]):
        self._spark, self._database, self._others = spark, database, others
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def __getitem__(self, name: str) -> DataFrame:
        return conform(self._spark.table(f"{self._database}.{name}"), name) if name in ORDER_IDS else self._others[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)
