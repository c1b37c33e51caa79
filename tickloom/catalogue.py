"""All registered queries of the engine."""

from __future__ import annotations

from .plans import bar_queries, data_queries


def queries() -> dict:
    return bar_queries.QUERIES | data_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return bar_queries.ORACLE | data_queries.ORACLE
