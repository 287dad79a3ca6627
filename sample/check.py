"""Runs a query and its SQL equivalent on the same files and compares the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from sample.oracle import ORACLE_SQL
from sample.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with every Parquet file of the folder as a view."""
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str
) -> str | None:
    """What differs between the two results, columns ordered by name; None if nothing."""
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    expected = connection.execute(ORACLE_SQL[name])
    expected_columns = [entry[0] for entry in expected.description]
    if columns != sorted(expected_columns):
        return f"columns {columns} against {sorted(expected_columns)}"
    order = [expected_columns.index(column) for column in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=repr)
    got = sorted((tuple(row) for row in found.select(*columns).collect()), key=repr)
    if got == wanted:
        return None
    extra = [row for row in got if row not in set(wanted)][:3]
    lost = [row for row in wanted if row not in set(got)][:3]
    return f"{len(got)} rows against {len(wanted)}; extra {extra}; missing {lost}"
