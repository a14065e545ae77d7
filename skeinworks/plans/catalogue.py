"""The catalogue of registered queries: a query and, where SQL can express it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skeinworks.plans import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of operators under its name, with its DuckDB SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = fixtures.oracle(oracle)
        return f

    return add


from skeinworks.plans import aggregates, facade, graphs, lattices, lookups, statistics, texts  # noqa: E402, F401
