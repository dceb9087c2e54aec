"""Compare registered queries with DuckDB, row by row, without regard to order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def compare(df, con, sql: str) -> list[str]:
    """Differences in words; empty when equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    types = {d[0]: str(d[1]) for d in result.description}
    got = [tuple(row) for row in df.collect()]
    order = sorted(names)
    left = sorted(tuple(plain(r[df.columns.index(c)]) for c in order) for r in got)
    right = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in expected)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {order}: {different[0]}")
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for f in df.schema:
        want = kinds.get(f.dataType.simpleString())
        if want and types[f.name] not in (want, "NUMBER", "STRING") and types[f.name] != want:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} against {types[f.name]}")
    return problems
