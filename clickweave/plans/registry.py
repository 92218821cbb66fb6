"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under ``key``, with the SQL text that must give the same rows."""

    def register(builder: Builder) -> Builder:
        if key in BUILDERS:
            raise ValueError(f"query {key} is registered twice")
        BUILDERS[key] = builder
        if sql is not None:
            SQL[key] = sql.strip()
        return builder

    return register
