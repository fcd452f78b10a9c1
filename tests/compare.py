"""Run a query in Spark and its SQL in DuckDB and compare the results as multisets of rows."""

from __future__ import annotations

import math

import duckdb

from respondry.operators import risk

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return canonical(names, cursor.fetchall())


def difference(expected, actual) -> str:
    """Empty when equal, else a short description."""
    if expected[0] != actual[0]:
        return f"columns {expected[0]} vs {actual[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"rows {len(expected[1])} vs {len(actual[1])}"
    wrong = [(e, a) for e, a in zip(expected[1], actual[1]) if e != a]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    types = [
        (name, type(e), type(a))
        for e, a in zip(expected[1], actual[1])
        for name, e, a in zip(expected[0], e, a)
        if type(e) is not type(a)
    ]
    return f"types {types[0]}" if types else ""


def assess(segmented):
    """Risk columns with the outcomes numbered by the table itself."""
    return risk.assess_risk(segmented, risk.outcome_labels(segmented))
