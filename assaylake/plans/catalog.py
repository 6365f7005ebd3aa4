"""Registry of queries: each has a Spark callable and, where SQL can say it, a SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaylake.plans.oracle import with_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("q_sources", "q_scalars", "q_joins", "q_aggregates", "q_selection", "q_mutation", "q_models",
            "q_streaming", "q_loops")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return add


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"assaylake.plans.{module}")
