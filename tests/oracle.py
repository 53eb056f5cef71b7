"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v := plain(r[i])).__name__, v) for i in order) for r in rows)


def compare(connection, sql: str, df) -> str | None:
    """None when equal, else what differs."""
    result = connection.sql(sql)
    expected_columns, expected = list(result.columns), result.fetchall()
    actual = df.collect()
    if sorted(expected_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(expected_columns)}"
    want, got = rows_of(expected_columns, expected), rows_of(df.columns, actual)
    if want == got:
        return None
    missing, extra = list((want - got).elements()), list((got - want).elements())
    return (f"rows {len(actual)} expected {len(expected)}; missing {len(missing)} {missing[:2]}; "
            f"extra {len(extra)} {extra[:2]}")
