"""Side-by-side check of a registered query with its SQL restatement."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def multiset(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list, list]:
    """Number of rows, and samples of rows that only one side has."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    right = multiset(names, expected.fetchall())
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    left = multiset(df.columns, rows)
    return len(rows), list((left - right).items())[:3], list((right - left).items())[:3]
