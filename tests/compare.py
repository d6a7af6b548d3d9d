"""Runs a query on Spark and its SQL on DuckDB and compares the rows as sorted multisets."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _order(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), _text(v)) for v in row)


def _text(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9e}"
    return str(v)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return type(a) is type(b) and a == b


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Messages on the first differences; empty if both results are equal, types included."""
    columns = sorted(spark_df.columns)
    result = con.execute(sql)
    theirs = [c[0] for c in result.description]
    if sorted(theirs) != columns:
        return [f"columns {columns} != {sorted(theirs)}"]
    places = [theirs.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=_order)
    actual = sorted((tuple(r) for r in spark_df.select(*(f"`{c}`" for c in columns)).collect()), key=_order)
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)} rows"]
    found = []
    for a, e in zip(actual, expected, strict=True):
        bad = [(c, x, y) for c, x, y in zip(columns, a, e, strict=True) if not _same(x, y)]
        if bad:
            found.append(f"{bad} in {a}")
    return found[:3] + ([f"... {len(found)} rows differ"] if found else [])
