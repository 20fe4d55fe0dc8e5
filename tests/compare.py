"""Side-by-side comparison of a Spark query and its SQL text on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        path = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_cell(row[n]) for n in names) for row in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    rows = [tuple(_cell(row[i]) for i in at) for row in done.fetchall()]
    return names, sorted(rows, key=repr)
