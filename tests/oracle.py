"""Runs the oracle SQL in DuckDB and compares rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, list]:
    """Row count of ``df``, and up to ten rows that only one side has."""
    found = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_by_name(names, result.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    only_spark = [("spark", *r) for r in list((found - expected))[:5]]
    only_oracle = [("oracle", *r) for r in list((expected - found))[:5]]
    return sum(found.values()), only_spark + only_oracle
