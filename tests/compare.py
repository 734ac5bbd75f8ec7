"""Spark result against DuckDB result: same columns, types, rows and values."""

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, Decimal):
        return "decimal"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, dt.datetime):
        return "time" if value.tzinfo is None else "zoned time"
    return type(value).__name__


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    kinds = {}
    for row in rows:
        for i in order:
            if row[i] is not None:
                kinds.setdefault(columns[i], _kind(row[i]))
    plain = sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)
    return names, kinds, plain


def compare(df, con, sql):
    """None if equal, else a description of the first difference."""
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = _table([d[0] for d in cursor.description], cursor.fetchall())
    for label, a, b in zip(("columns", "types", "rows"), got, want):
        if a != b:
            if label == "rows" and len(a) == len(b):
                diff = [(x, y) for x, y in zip(a, b) if x != y]
                return f"{len(diff)} of {len(a)} rows differ, first: {diff[0]}"
            if label == "rows":
                return f"row counts {len(a)} and {len(b)}; spark {a[:2]}, sql {b[:2]}"
            return f"{label}: spark {a}, sql {b}"
    return None
