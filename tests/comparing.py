"""Compare a Spark result with an SQL oracle: names, types, rows, exact values."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _counted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    ours = {name: _TYPE.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        wrong = {k: (ours.get(k), theirs.get(k)) for k in ours | theirs if ours.get(k) != theirs.get(k)}
        found.append(f"schema: {wrong}")
    if set(ours) != set(theirs):
        return found
    left = _counted(df.columns, [tuple(r) for r in df.collect()])
    right = _counted(list(theirs), rows)
    if left != right:
        found.append(f"rows {sum(left.values())} against {sum(right.values())}")
        found.append(f"only Spark: {list((left - right).items())[:2]}")
        found.append(f"only SQL: {list((right - left).items())[:2]}")
    elif not left:
        found.append("empty")
    return found
