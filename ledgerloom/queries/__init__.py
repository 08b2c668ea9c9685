"""Queries over the test tables, each with the SQL that gives the same rows."""

from ledgerloom.queries import checks, functions, operators, sources, validation, warehouse  # noqa: F401
from ledgerloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
