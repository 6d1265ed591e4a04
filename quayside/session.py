"""Session settings the reports rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    # A zero divisor and an ambiguous lookup must fail the job, not yield NULL.
    "spark.sql.ansi.enabled": "true",
    # Instants, if a source delivers them, are cut to days and months in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # A product of wide decimals keeps all decimal places; one that does not fit is an error.
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
}

TUNING = {
    # A scan counts for eight times its file size when Spark decides what is small enough to
    # broadcast: parquet files unpack to about that. The limit is meant in unpacked bytes.
    "spark.sql.sources.fileCompressionFactor": "8",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Joins are planned again by measured sizes, and hot join keys are split. The last setting
    # splits them also where a further join or grouping on the same key follows.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task reads shuffled rows packed and sorts or groups them unpacked, in eight times the room and more. Pieces of
    # this size keep its memory at some hundred MB whatever the size of the input; a hot piece is split from four of them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # The same for tasks that read files: they keep what they write to a shuffle in memory until it is sorted.
    "spark.sql.files.maxPartitionBytes": "32MB",
}

SHUFFLE_CUTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: What ``SHUFFLE_CUTS`` was set to here; another value there is the user's and stays.
OWN_CUTS = "quayside.shuffle.cuts"
CUTS_PER_CORE = 3
#: The advisory size is that of packed pieces, an input's size that of unpacked rows, of which a shuffle takes some columns.
UNPACKED = 4
#: Beyond this the bookkeeping of a shuffle costs more than its larger pieces do.
MOST_CUTS = 100_000


def prepare(spark: SparkSession) -> SparkSession:
    """Apply ``REQUIRED``, and what of ``TUNING`` the session does not set itself; return the session.

    Shuffles are cut finely enough for all cores to begin with, and for the data once a report is
    known (``size_shuffles``); small pieces are put together again by measured size.
    """
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in TUNING.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if spark.conf.get(SHUFFLE_CUTS, None) is None:
        _set_cuts(spark, shuffle_cuts(0, 1, _least_cuts(spark)))
    return spark


def size_shuffles(rows: DataFrame) -> None:
    """Cut the shuffles of what ``rows`` is about to run by the size of its inputs.

    The size is that of the plan's scans, which Spark knows without a job; inputs of unknown size
    (a database) count for nothing. A number that the session sets itself stays.
    """
    spark = rows.sparkSession
    if spark.conf.get(SHUFFLE_CUTS, None) != spark.conf.get(OWN_CUTS, None):
        return
    advisory = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY))
    _set_cuts(spark, shuffle_cuts(input_bytes(rows), UNPACKED * advisory, _least_cuts(spark)))


def input_bytes(rows: DataFrame) -> int:
    """The unpacked size of what a plan reads, as Spark estimates it from file sizes."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(rows.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < unknown)


def shuffle_cuts(size: int, advisory: int, least: int) -> int:
    """Pieces of the advisory size in ``size`` bytes: ``least`` at least, ``MOST_CUTS`` at most."""
    return min(MOST_CUTS, max(least, -(-size // advisory)))


def current_cuts(spark: SparkSession) -> int:
    """Into how many pieces shuffles are cut at first."""
    return int(spark.conf.get(SHUFFLE_CUTS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _least_cuts(spark: SparkSession) -> int:
    return max(CUTS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _set_cuts(spark: SparkSession, cuts: int) -> None:
    spark.conf.set(SHUFFLE_CUTS, str(cuts))
    spark.conf.set(OWN_CUTS, str(cuts))


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="quayside-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """Path of a new, not yet existing folder that every executor can reach.

    It lies under the session's checkpoint folder. Only a local session, whose tasks all run on
    this machine, may go without one; its folder is removed when the program ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
