"""Registered queries: a Spark function of (mart inputs) and, where SQL can say it, the DuckDB text for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verification.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, oracle: str | None = None, steps: dict[str, str] | None = None):
    def register(query: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = with_views(oracle, steps)
        return query

    return register


def first_row(table: str, keys: str, order: str) -> str:
    """SQL for the first row per key, NULLs last."""
    ordered = ", ".join(f"{c.strip()} NULLS LAST" for c in order.split(","))
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) AS rn FROM {table}) AS w "
        "WHERE rn = 1)"
    )
