"""Named queries over the sample tables, with the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` computes the same on the raw tables."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load() -> None:
    """Import the modules that register queries."""
    from retailflow.plans import (  # noqa: F401
        queries_batch,
        queries_files,
        queries_flow,
        queries_quality,
        queries_streams,
    )
