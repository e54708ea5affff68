"""Run a registered query on Spark and its oracle on DuckDB, and compare like the driver does:
row count, column names, and an order-insensitive comparison of the values."""

from __future__ import annotations

import decimal
import math

import duckdb

from tillbook.sources.tables import TABLES, table_path

ALL_TABLES = TABLES + ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


# Physical operators no registered query may use: every pairing is an equi join, and one-row
# aggregates are scalar subqueries, so a cartesian or nested-loop join is a planning mistake.
FORBIDDEN_OPERATORS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    used = [op for op in FORBIDDEN_OPERATORS if op in plan]
    if used:
        return False, f"plan uses {used}"
    cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    if sorted(d_cols) != cols:
        return False, f"columns differ: spark={sorted(sdf.columns)} duck={sorted(d_cols)}"
    idx = [d_cols.index(c) for c in cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows"
