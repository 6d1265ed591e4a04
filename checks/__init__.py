"""Every operator and report as a query over the test tables, with its SQL counterpart."""

from checks import columns, relations, reports, storage  # noqa: F401  (they fill the registry)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
