"""Where queries and the SQL that they must equal are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query by its function's name, with its SQL where SQL can express it."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add
