"""Registered queries, each beside the SQL that gives the same rows.

The SQL works on the given tables alone. Where a query renders pages and reads them back,
the SQL computes the answer straight from the table the pages were rendered from.
"""

from shelfloom.plans.queries import (
    extraction,
    files,
    html,
    queues,
    streams,
    tables,
    values,
)
from shelfloom.plans.queries.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "extraction",
    "files",
    "html",
    "queues",
    "streams",
    "tables",
    "values",
]
