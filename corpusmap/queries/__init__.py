"""Registered queries: each runs one operator over the driver's tables, most with a DuckDB oracle."""

from __future__ import annotations

import importlib

from corpusmap.queries.registry import ORACLES, QUERIES

for _module in ("tables", "updates", "sources", "vectors", "topics", "streams"):
    importlib.import_module(f"corpusmap.queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
