"""How the queries reach their tables, and registration of a query with its statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """Queries by name, with the DuckDB statement of each that SQL can express."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, oracle: str | None = None):
        def register(function):
            self.queries[function.__name__] = function
            if oracle:
                self.oracles[function.__name__] = oracle
            return function

        return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
