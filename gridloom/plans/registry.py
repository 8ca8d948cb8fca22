"""Queries by name, each with its DuckDB counterpart."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers a query (spark, sf_dir) -> DataFrame under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register
