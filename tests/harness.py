"""Compare a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def kinds(names, types):
    """Coarse column kinds, so that a string never passes for a number."""

    def coarse(kind: str) -> str:
        kind = kind.lower()
        for word, group in (
            ("timestamp", "time"), ("double", "float"), ("float", "float"),
            ("decimal", "decimal"), ("bool", "bool"), ("string", "text"), ("varchar", "text"),
            ("json", "json"), ("hugeint", "huge"), ("int", "int"), ("long", "int"),
        ):
            if word in kind:
                return group
        return kind

    return sorted((n, coarse(t)) for n, t in zip(names, types))


def spark_side(df):
    rows = [tuple(r) for r in df.collect()]
    types = [f.dataType.simpleString() for f in df.schema.fields]
    return df.columns, types, rows


def duck_side(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return names, types, cursor.fetchall()


def differences(df, connection, sql, show=3) -> str | None:
    """None when equal, else what differs."""
    s_names, s_types, s_rows = spark_side(df)
    d_names, d_types, d_rows = duck_side(connection, sql)
    if sorted(s_names) != sorted(d_names):
        return f"columns {sorted(s_names)} / {sorted(d_names)}"
    if kinds(s_names, s_types) != kinds(d_names, d_types):
        return f"types {kinds(s_names, s_types)} / {kinds(d_names, d_types)}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} / {len(d_rows)}"
    left, right = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b][:show]
        return f"values (columns {sorted(s_names)}): " + "; ".join(map(str, pairs))
    return None
