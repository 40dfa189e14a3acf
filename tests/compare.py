"""Compare a Spark result with the DuckDB result of the same question."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(normal(v)) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=lambda t: tuple(str(v) for v in t))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short description."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = rows_of(columns, result.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"row {a} != {b}"
    return None
