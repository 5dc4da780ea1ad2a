"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return str(decimal.Decimal(value).normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode()
    return value if value is None else str(value)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df: DataFrame) -> tuple[list[str], Counter]:
    return sorted(df.columns), _bag(df.columns, df.collect())


def sql_bag(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _bag(columns, cursor.fetchall())
