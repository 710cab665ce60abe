"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(tables_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(tables_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(frame, con, sql: str) -> str | None:
    """None when both give the same columns, kinds of types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).split("(")[0] for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    kinds = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for name, dtype in frame.dtypes:
        if kinds.get(dtype) != types[name].upper():
            return f"type of {name}: {dtype} != {types[name]}"
    actual = _rows(frame.columns, frame.collect())
    if actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e][:3]
        return f"{len(actual)} rows, expected {len(expected)}; first differences {wrong}"
    return None
