"""Run a query and its SQL on the same tables and compare names, types and values as bags."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return value


def bag(rows, order):
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r)))


def kind(name: str) -> str:
    name = name.lower()
    return {
        "integer": "int", "varchar": "string", "bigint": "bigint", "double": "double", "boolean": "boolean",
        "date": "date", "float": "float",
    }.get(name, name)


def differences(df, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    names, expected_names = df.columns, relation.columns
    if sorted(names) != sorted(expected_names):
        return [f"columns {sorted(names)} != {sorted(expected_names)}"]
    ordered = sorted(names)
    found = []
    types = dict(df.dtypes)
    expected_types = dict(zip(expected_names, map(str, relation.types)))
    for name in ordered:
        if kind(expected_types[name]) != types[name]:
            found.append(f"type of {name}: {types[name]} != {expected_types[name]}")
    rows = bag([tuple(row) for row in df.collect()], [names.index(n) for n in ordered])
    expected = bag(relation.fetchall(), [expected_names.index(n) for n in ordered])
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, e.g. {ordered}: {wrong[0]}")
    if not rows:
        found.append("no rows")
    return found
