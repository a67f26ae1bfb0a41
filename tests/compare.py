"""Run a query on Spark and its SQL on DuckDB and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, 0.0 if v == 0 else float(v))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql, limit=5):
    """An empty list when both sides agree, else what differs first."""
    spark_columns, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    sql_columns, sql_rows = rows_of([c[0] for c in result.description], result.fetchall())
    if spark_columns != sql_columns:
        return [f"columns {spark_columns} vs {sql_columns}"]
    if len(spark_rows) != len(sql_rows):
        return [f"rows {len(spark_rows)} vs {len(sql_rows)}"]
    return [f"{spark_columns}\n  {a}\n  {b}" for a, b in zip(spark_rows, sql_rows) if a != b][:limit]
