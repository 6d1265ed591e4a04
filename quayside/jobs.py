"""A batch of reports, each written as its own snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame

from quayside.files import Change, publish_all
from quayside.plans import REPORTS
from quayside.sinks import stage_snapshot

# Field separators of the reports.
SEPARATORS = {
    "prepack_in": ";",
    "prepack_out": ";",
    "gate_putaway": ";",
    "offload": ";",
    "cartons": ";",
    "stock_weight": ",",
    "loadlist": ";",
}


def run(
    tables: Mapping[str, DataFrame], arguments: Mapping[str, Mapping[str, Any]], out: str, compact: bool = False
) -> None:
    """Write each report named in ``arguments`` to ``<out>/<report>``: all of them, or none if one fails.

    All reports are worked out and written aside before the first is published, so that the snapshots
    are of one run; a failure, also one while publishing, leaves every old snapshot as it is.
    """
    unknown = set(arguments) - set(REPORTS)
    if unknown:
        raise ValueError(f"no such report: {', '.join(sorted(unknown))}")
    staged: list[Change] = []
    try:
        for name, values in arguments.items():
            rows = REPORTS[name](tables, **values)
            staged.append(stage_snapshot(rows, f"{out.rstrip('/')}/{name}", SEPARATORS[name], compact=compact))
    except BaseException:
        for change in staged:
            change.discard()
        raise
    publish_all(staged)


def read_arguments(settings: Mapping[str, Mapping[str, Any]]) -> dict[str, dict[str, Any]]:
    """Report arguments from parsed JSON, where days and times are ISO text."""
    parsers = {"since": date.fromisoformat, "as_of": datetime.fromisoformat}
    return {
        report: {key: parsers[key](value) if key in parsers else value for key, value in values.items()}
        for report, values in settings.items()
    }
