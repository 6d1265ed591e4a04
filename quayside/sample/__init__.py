"""The warehouse tables derived from order-processing test tables (``FIXTURES.md``)."""

from quayside.sample.arguments import ARGUMENTS
from quayside.sample.tables import SampleTables, with_views

__all__ = ["ARGUMENTS", "SampleTables", "with_views"]
