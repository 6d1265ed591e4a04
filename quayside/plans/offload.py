"""Quantity put away per month, item, tag and place it came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import yymm
from quayside.operators import keep_listed, named, scope, union_of_sums
from quayside.operators import since as stamped_since
from quayside.plans.headers import OFFLOAD


def offload(
    tables: Mapping[str, DataFrame],
    site: str,
    since: date,
    from_locs: Sequence[str] | None = None,
    zones: Sequence[str] | None = None,
    code: str = "Putaway",
) -> DataFrame:
    """Sums over current and archived moves, as a set union of the two.

    The places are given by id (``from_locs``), by their work zone (``zones``) or by both.
    """
    if from_locs is None and zones is None:
        raise ValueError("give from_locs, zones or both")

    def moves(name: str) -> DataFrame:
        rows = stamped_since(scope(tables[name], site_id=site, code=code), since)
        if from_locs is not None:
            rows = rows.filter(F.col("from_loc_id").isin(*from_locs))
        return rows.select(yymm("dstamp").alias("yymm"), "sku_id", "tag_id", "from_loc_id", "update_qty")

    sums = union_of_sums(
        moves("inventory_transaction"),
        moves("inventory_transaction_archive"),
        ["yymm", "sku_id", "tag_id", "from_loc_id"],
        "update_qty",
    )
    if zones is not None:
        # The place is a grouping key: after the sum there are fewer rows to check, and one busy
        # place is no hot key any more.
        places = scope(tables["location"], site_id=site).filter(F.col("work_zone").isin(*zones))
        sums = keep_listed(sums, "from_loc_id", places.select("location_id"))
    return named(sums.select("yymm", F.lit(code), "sku_id", "tag_id", "update_qty", "from_loc_id"), OFFLOAD)
