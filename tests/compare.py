"""Hold a Spark result against SQL over the same tables, whatever the order of rows."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want, have = rows(names, got.fetchall()), rows(df.columns, df.collect())
    if want == have:
        return None
    only = [r for r in have if r not in want][:3], [r for r in want if r not in have][:3]
    return f"{len(have)} rows and {len(want)}; only in one: {only[0]} {only[1]}"
