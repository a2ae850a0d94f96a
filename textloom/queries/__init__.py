"""One registered query per operator, with the same result stated in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` only its rows are checked, and its values by the tests."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for CPU-heavy text work: spread over the cores when the file has too few splits."""
    return spread(table(spark, sf_dir, name))
