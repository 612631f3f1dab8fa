"""Run a registered query and its SQL over the same files and compare the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(lines, key=lambda line: tuple((v is None, str(v)) for v in line))


# Spark type to the DuckDB types it may stand against.
SAME = {
    "int": {"INTEGER"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def differences(name: str, frame, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    found = []
    spark_types = dict(frame.dtypes)
    duck_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    if set(spark_types) != set(duck_types):
        return [f"{name}: columns differ: {sorted(set(spark_types) ^ set(duck_types))}"]
    for column, kind in spark_types.items():
        if duck_types[column] not in SAME.get(kind, {kind}):
            found.append(f"{name}: {column} is {kind} here and {duck_types[column]} there")
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = rows_of(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"{name}: {len(ours)} rows here and {len(theirs)} there")
    elif ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{name}: {len(wrong)} of {len(ours)} rows differ, first {wrong[0]}")
    elif not ours:
        found.append(f"{name}: no rows")
    return found
