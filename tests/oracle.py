"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def spark_side(df):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_side(con, sql: str):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), canonical(columns, cur.fetchall())
