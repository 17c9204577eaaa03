"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted_rows(rows, order):
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return sorted(df.columns), _sorted_rows([tuple(r) for r in df.collect()], order)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), _sorted_rows(result.fetchall(), order)


def difference(mine, theirs) -> str | None:
    (names, rows), (other_names, other_rows) = mine, theirs
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)}"
    for a, b in zip(rows, other_rows):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return None
