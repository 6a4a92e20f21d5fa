"""Registered queries and their comparison SQL."""

from loomdex.catalog import layouts, search, tables, texts  # noqa: F401
from loomdex.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
