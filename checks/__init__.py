"""Registered queries and the SQL that states their results, side by side by subject."""

from checks import extraction, feeds, keyed, monitoring, phrases, rows, texts  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
