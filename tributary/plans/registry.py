"""Registry of runnable queries: key → (Spark query, SQL with the same answer)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.session import tune
from tributary.tables import Tables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(tune(spark), sf_dir))


QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = Query(key, build, oracle)
        return build

    return register
