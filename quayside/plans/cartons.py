"""Number of cartons per day, type and status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import day, yymm
from quayside.operators import named, scope
from quayside.operators import since as stamped_since
from quayside.plans.headers import CARTONS


def cartons(tables: Mapping[str, DataFrame], site: str, types: Sequence[str], since: date) -> DataFrame:
    """Containers of the given types, of all clients, counted from ``since`` on."""
    boxes = stamped_since(scope(tables["order_container"], v_site_id=site), since)
    counts = (
        boxes.filter(F.col("v_container_type").isin(*types))
        .groupBy(day("dstamp").alias("day"), "v_container_type", "v_infoship_status")
        .agg(F.count("*").alias("boxes"))
    )
    # The month follows from the day, so it need not be a grouping key.
    rows = counts.select(yymm("day"), "day", "v_container_type", "v_infoship_status", "boxes")
    return named(rows, CARTONS)
