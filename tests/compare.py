"""Runs a query and its SQL, and compares them as sets of rows with types."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        tuple("NULL" if r[i] is None else f"{type(r[i]).__name__}:{r[i]!r}" for i in order) for r in rows
    )


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def differences(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    expected = con.sql(sql)
    types = {c: str(t) for c, t in zip(expected.columns, expected.types)}
    mine = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    if types != mine:
        return f"schema: sql {types} != spark {mine}"
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b = _rows(expected.columns, expected.fetchall())
    if len(a) != len(b):
        return f"rows: spark {len(a)} != sql {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference: spark {x} != sql {y}"
    return None
