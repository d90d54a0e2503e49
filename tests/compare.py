"""Rows of a query against those of its SQL counterpart."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return c


def value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
    if isinstance(x, (list, tuple)):
        return tuple(map(value, x))
    return x


def rows(names: list[str], found) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(value(r[i]) for i in order) for r in found)


def differences(spark_df, sql: str, sf_dir: str) -> tuple[list, list]:
    """(rows only Spark has, rows only SQL has)."""
    c = duck(sf_dir).execute(sql)
    names = [d[0] for d in c.description]
    assert sorted(names) == sorted(spark_df.columns), (names, spark_df.columns)
    a, b = rows(spark_df.columns, spark_df.collect()), rows(names, c.fetchall())
    return list((a - b).elements()), list((b - a).elements())
