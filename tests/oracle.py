"""Compare registered queries with their expected SQL, run by DuckDB."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a statement's result, or None."""
    kinds = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    found = {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}
    if found.keys() != kinds.keys():
        return f"columns {sorted(found)}, expected {sorted(kinds)}"
    odd = {name: (found[name], kinds[name]) for name in kinds if found[name] != kinds[name]}
    left = _ordered(df.collect(), df.columns)
    right = _ordered(con.execute(sql).fetchall(), list(kinds))
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(wrong)} of {len(left)} rows differ, e.g. {wrong[0]}"
    if odd:
        return f"types differ: {odd}"
    return None
