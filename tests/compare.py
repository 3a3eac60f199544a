"""Run the fixture queries on Spark and DuckDB and compare every value."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return str(value)
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ")
    return repr(value.item() if hasattr(value, "item") else value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, themselves in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, v or "") for v in row))


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DECIMAL(18,2)": "decimal(18,2)",
}


def spark_result(df) -> tuple[dict[str, str], list[tuple]]:
    return dict(df.dtypes), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(connection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    return kinds, rows_of(columns, result.fetchall())
