"""Compare a Spark result with the result of its SQL on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_SQL = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE",
}


def connect(folder: str):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def differences(df, rows, db, sql) -> list[str]:
    """What differs between a collected DataFrame and its SQL; empty when they agree in columns, types and rows."""
    cursor = db.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(types):
        return [f"columns {sorted(df.columns)} != {sorted(types)}"]
    out = [f"type of {n}: {t} != {types[n]}" for n, t in df.dtypes if SPARK_TO_SQL.get(t, t) != types[n]]
    a, b = rows_of(df.columns, rows), rows_of(list(types), want)
    if a != b:
        in_a, in_b = set(a), set(b)
        out.append(f"{len(a)} rows, SQL {len(b)}")
        out += [f"  spark: {str(r)[:400]}" for r in a if r not in in_b][:3] + [f"  sql  : {str(r)[:400]}" for r in b if r not in in_a][:3]
    return out
