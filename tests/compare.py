"""Compare a Spark result with a DuckDB result: columns, types, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(df, connection, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    cursor = connection.execute(sql)
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    names = sorted(df.columns)
    if names != sorted(expected_types):
        return [f"columns {names} and {sorted(expected_types)}"]
    found = [
        f"type of {name}: {kind} and {expected_types[name]}"
        for name, kind in df.dtypes
        if TYPES.get(kind, kind) != expected_types[name]
    ]
    order = list(expected_types)
    expected = _sorted(
        tuple(_plain(row[order.index(n)]) for n in names) for row in cursor.fetchall()
    )
    actual = _sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())
    if len(expected) != len(actual):
        found.append(f"{len(actual)} rows and {len(expected)}")
    pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
    found += [f"row {str(a)[:300]} and {str(e)[:300]}" for a, e in pairs[:2]]
    return found
