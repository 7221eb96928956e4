"""Queries over the given tables and the SQL they must agree with."""

from quipyard.catalog import files, pairs, texts  # noqa: F401  (fills the registry)
from quipyard.catalog.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
