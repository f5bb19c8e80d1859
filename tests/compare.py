"""Run a named query in Spark and its SQL counterpart in DuckDB and compare all values."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def differences(df, connection, sql: str) -> list[str]:
    """Empty when names, row count, values and Python types agree exactly."""
    mine, rows = spark_rows(df)
    theirs, expected = oracle_rows(connection, sql)
    if mine != theirs:
        return [f"columns {mine} != {theirs}"]
    if len(rows) != len(expected):
        return [f"{len(rows)} rows != {len(expected)}"]
    found = []
    for a, b in zip(rows, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            found.append(f"{dict(zip(mine, a))} != {dict(zip(mine, b))}")
    return found
