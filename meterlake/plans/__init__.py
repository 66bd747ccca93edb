"""Registered queries over the test tables with their DuckDB equivalents."""

from meterlake.plans import storage, streams  # noqa: F401  (register writing queries)
from meterlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
