"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# EXACT=1 compares doubles bit by bit instead of to six digits.
EXACT = os.environ.get("EXACT") == "1"


def sql_engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if EXACT else f"f{round(value, 6) + 0.0:.6f}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "float": "FLOAT",
}


def differences(spark_df, con, sql) -> list[str]:
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_cols, want = rows_of(names, cursor.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
        return problems
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:3]
        problems.append(f"values differ in {sum(g != w for g, w in zip(got, want))} rows, e.g. {bad}")
    return problems
