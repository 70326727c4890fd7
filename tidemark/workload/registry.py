"""Pairs a query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workload.market import Market


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Columns whose last digits depend on the order of summation, rounded as in their SQL."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register a function of a :class:`Market` under its own name."""

        def register(build: Callable[[Market], DataFrame]):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return build(Market(spark, folder))

            run.__name__ = build.__name__
            run.__doc__ = build.__doc__
            self.queries[build.__name__] = run
            if sql is not None:
                self.sql[build.__name__] = sql
            return build

        return register
