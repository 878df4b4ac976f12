"""Holds a query's rows against its SQL, as the driver does: columns by name, rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        path = sorted(glob.glob(f"{path}/*.parquet"))[0].rsplit("/", 1)[0] + "/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value.isoformat() if hasattr(value, "isoformat") else str(value) if value is not None else None


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, query, sql: str, folder: str) -> int:
    df = query(spark, folder)
    ours = rows(df.columns, df.collect())
    result = connect(folder).execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    assert not different, (len(different), different[:3])
    return len(ours)
