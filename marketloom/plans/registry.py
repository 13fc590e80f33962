"""Queries by name with the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a data folder by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


def query(sql: str | None = None) -> Callable:
    """Registers a function from tables to a DataFrame under its own name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register
