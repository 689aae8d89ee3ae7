"""Run a query on Spark and its SQL counterpart on DuckDB, and compare."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def compare(frame, connection, sql: str) -> int:
    """Both results as sorted rows with columns in name order; gives the row count."""
    names = sorted(frame.columns)
    result = connection.execute(sql)
    found = [column[0] for column in result.description]
    assert sorted(found) == names
    order = [found.index(name) for name in names]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    actual = sorted((tuple(row) for row in frame.select(*names).collect()), key=repr)
    assert len(actual) == len(expected)
    for mine, theirs in zip(actual, expected):
        assert mine == theirs
    return len(actual)
