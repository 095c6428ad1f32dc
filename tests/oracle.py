"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def cell(v, digits: int | None):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None:
            v = float(f"{v:.{digits}g}")
        return ("f", v + 0.0)
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(cell(x, digits) for x in v)
    return repr(v)


def rows_of(names, rows, digits):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i], digits) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql, sf_dir, digits=None):
    """(problem or None, Spark rows, DuckDB rows)."""
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}", spark_rows, duck_rows
    a, b = rows_of(df.columns, spark_rows, digits), rows_of(names, duck_rows, digits)
    if len(a) != len(b):
        return f"rows {len(a)} <> {len(b)}", spark_rows, duck_rows
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(names)}), first {bad[0]}", spark_rows, duck_rows
    return None, spark_rows, duck_rows
