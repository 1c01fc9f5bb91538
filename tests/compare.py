"""Run a registered query on Spark and its SQL on DuckDB, and compare schema and rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(directory).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty if they agree."""
    con.execute(sql)
    expected_schema = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in con.description}
    expected = con.fetchall()
    schema = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    faults = []
    if schema != expected_schema:
        faults.append(f"schema: spark-only {set(schema.items()) - set(expected_schema.items())}, sql-only {set(expected_schema.items()) - set(schema.items())}")
    if set(schema) != set(expected_schema):
        return faults
    names = sorted(schema)
    order = [list(expected_schema).index(n) for n in names]
    want = Counter(tuple(plain(row[i]) for i in order) for row in expected)
    got = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    if want != got:
        extra, missing = got - want, want - got
        faults.append(
            f"rows: spark {sum(got.values())}, sql {sum(want.values())}; "
            f"only spark {list(extra.items())[:3]}; only sql {list(missing.items())[:3]}; columns {names}"
        )
    return faults
