"""Output headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def named(rows: DataFrame, header: Sequence[str]) -> DataFrame:
    """Give the columns the header's names by position, whatever they were called before."""
    if len(rows.columns) != len(header):
        raise ValueError(f"{len(rows.columns)} columns for {len(header)} names")
    return rows.toDF(*header)
