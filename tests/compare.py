"""Comparing a Spark result with the answer DuckDB gives over the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_of(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*names).collect())


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
