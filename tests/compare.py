"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df, sql: str, connection) -> str | None:
    """None when both sides hold the same columns and rows, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    odd = [(a, b) for a, b in zip(got, expected) if a != b]
    return f"{len(odd)} rows differ, e.g. {odd[:2]}" if odd else None
