"""Relational building blocks of the reports, ``DataFrame`` in and ``DataFrame`` out."""

from quayside.operators.filters import not_in, scope, since
from quayside.operators.joins import (
    checked_value,
    keep_listed,
    lookup,
    single_value,
    single_value_lookup,
)
from quayside.operators.naming import named
from quayside.operators.sets import union_distinct, union_of_sums

__all__ = [
    "checked_value",
    "keep_listed",
    "lookup",
    "named",
    "not_in",
    "scope",
    "since",
    "single_value",
    "single_value_lookup",
    "union_distinct",
    "union_of_sums",
]
