"""Registered queries: the library's operators over the given tables.

Each query is registered together with the SQL that gives the same rows, where SQL
can express it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"Query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load() -> None:
    """Import the modules that register queries."""
    for module in ("validation", "transforms", "joining", "codecs", "tables", "streams"):
        importlib.import_module(f"registry.{module}")
