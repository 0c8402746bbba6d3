"""Runs a query and its SQL twin side by side and compares rows, order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


# Spark type -> type names the SQL engine may use for it.
SAME = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def differences(frame, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    expected = con.execute(sql).fetchall()
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    out = [
        f"type of {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}"
        for f in frame.schema
        if kinds[f.name] not in SAME.get(f.dataType.simpleString(), set())
    ]
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    want = _rows(names, expected)
    if len(got) != len(want):
        out.append(f"{len(got)} rows, expected {len(want)}")
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        missing = sorted(set(want) - set(got))[:3]
        out.append(f"extra {extra}, missing {missing}")
    return out
