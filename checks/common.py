"""Shared by the registered checks: table access and exact numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries of a family with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
        """Register ``fn(t)``, where ``t(name)`` reads a table of the folder."""

        def register(fn: Callable) -> Callable:
            def query(spark: SparkSession, folder: str) -> DataFrame:
                return fn(lambda table: read_table(spark, folder, table))

            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def dec(c: str | Column, p: int = 18, s: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({p},{s})")
