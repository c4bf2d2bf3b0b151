"""Run a report in Spark and its SQL in DuckDB, and compare types and values."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return v


def _rows(rows, order):
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences between a Spark result and a DuckDB result."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    right_types = {r[0]: r[1] for r in described}
    left_types = {n: SAME_TYPE.get(t, t) for n, t in df.dtypes}
    if left_types != right_types:
        return [f"schema {sorted(left_types.items())} != {sorted(right_types.items())}"]
    names = sorted(left_types)
    left = _rows(df.collect(), [df.columns.index(n) for n in names])
    right_columns = [r[0] for r in described]
    right = _rows(con.execute(sql).fetchall(), [right_columns.index(n) for n in names])
    found = []
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        found.append(f"{names}: spark only {list(a - b)[:3]}, sql only {list(b - a)[:3]}")
    if not left:
        found.append("no rows")
    return found
