"""Compare a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns, tuples) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    rows = sorted((tuple(t[i] for i in order) for t in tuples), key=repr)
    return names, rows


# Spark type -> DuckDB type
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results, none if they agree."""
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    types = {d[0]: str(d[1]) for d in cursor.description}
    problems = []
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} / {theirs[0]}"]
    for f in df.schema:
        expected = KINDS.get(f.dataType.simpleString())
        if expected and types[f.name] != expected:
            problems.append(f"type of {f.name}: {expected} / {types[f.name]}")
    if len(ours[1]) != len(theirs[1]):
        problems.append(f"rows {len(ours[1])} / {len(theirs[1])}")
    a, b = set(map(repr, ours[1])), set(map(repr, theirs[1]))
    if ours[1] != theirs[1]:
        problems.append(f"only in Spark ({len(a - b)}): {sorted(a - b)[:2]}")
        problems.append(f"only in SQL ({len(b - a)}): {sorted(b - a)[:2]}")
    return problems
