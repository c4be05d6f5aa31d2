"""Registered queries: every entry runs one operator over the given tables and,
where SQL can say the same, carries that SQL for the comparison."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

FAMILIES = [
    "invoices", "relational", "windows", "semistructured", "changes", "streaming", "health", "lineage", "rules", "semantic", "text", "trucks", "sources",
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
