"""Spark-vs-DuckDB comparison in the driver's terms.

Row count, column names (sorted) and an order-insensitive hash of the
values; columns are compared by name, so their order does not matter.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


# Spark's and DuckDB's names of the types that results use.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "boolean": "BOOLEAN",
                 "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
                 "date": "DATE", "decimal(38,18)": "DECIMAL(38,18)", "decimal(38,36)": "DECIMAL(38,36)"}


def types_differ(df, con, sql) -> dict:
    """Columns whose types differ: name -> (Spark, oracle)."""
    ours = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (ours.get(c), theirs.get(c)) for c in {*ours, *theirs} if ours.get(c) != theirs.get(c)}


def spark_result(df):
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    return cols, rows


def duck_result(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(df, con, sql) -> dict:
    s_cols, s_rows = spark_result(df)
    d_cols, d_rows = duck_result(con, sql)
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": False,
        "types_differ": types_differ(df, con, sql),
    }
    if out["columns_match"]:
        out["hash_match"] = digest(s_cols, s_rows) == digest(d_cols, d_rows)
    else:
        out["columns_spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["columns_oracle_only"] = sorted(set(d_cols) - set(s_cols))
    out["ok"] = not out["types_differ"] and out["columns_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out
