"""Registered queries: every operator over the given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketloom.testbed import Bed


@dataclass(frozen=True)
class Query:
    name: str
    make: Callable[[Bed], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.make(Bed.of(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register ``make(bed) -> DataFrame`` under its function name."""
    def add(make):
        key = name or make.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, make, oracle)
        return make

    return add


def all_queries() -> dict[str, Query]:
    from marketloom.queries import graph, marts, runs, silver, sources  # noqa: F401 (they register)

    return REGISTRY
