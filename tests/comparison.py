"""Spark result against DuckDB result: same columns and types, same bag of rows."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return round(value, 9)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


def difference(df, connection, sql):
    """None if equal, else a short description."""
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if types != theirs:
        return f"types {set(types.items()) ^ set(theirs.items())}"
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    theirs = bag(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows != {sum(theirs.values())} rows; "
        f"ours only {list((ours - theirs).items())[:2]}; "
        f"theirs only {list((theirs - ours).items())[:2]}"
    )
