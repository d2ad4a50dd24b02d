"""Runs a registered query and its SQL over one data folder and compares them as sets of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def expected_rows(connection, statement: str) -> tuple[list[str], list[str], Counter]:
    result = connection.execute(statement)
    names = [column[0] for column in result.description]
    types = [str(column[1]) for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [names[i] for i in order], [types[i] for i in order], rows


def actual_rows(frame) -> tuple[list[str], list[str], Counter]:
    names = sorted(frame.columns)
    types = [frame.schema[name].dataType.simpleString() for name in names]
    ordered = frame.select(*[f"`{name}`" for name in names])
    return names, types, Counter(tuple(row) for row in ordered.collect())


SQL_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
             "STRING": "string", "NUMBER": "number", "bool": "boolean"}
