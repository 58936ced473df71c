"""Compare a query with its SQL statement: same columns, same rows, values by type."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None if equal, otherwise a short description of the first difference."""
    got_columns, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        missing, extra = [r for r in want if r not in set(got)][:2], [r for r in got if r not in set(want)][:2]
        return f"{len(got)} rows, expected {len(want)}; missing {missing}; extra {extra}"
    if not got:
        return "both sides are empty"
    return None
