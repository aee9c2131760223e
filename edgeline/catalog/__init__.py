"""Every operator as a runnable query over the sample tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the statement that must agree with it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function

    return register


def load() -> None:
    from edgeline.catalog import algorithms, extraction, relational, serving, traversal  # noqa: F401
