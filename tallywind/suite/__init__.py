"""All registered queries."""

from tallywind.suite import groups, rows, scoring, windows  # noqa: F401
from tallywind.suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
