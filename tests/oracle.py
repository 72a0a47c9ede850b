"""Run a catalogue query and its SQL on the same tables and compare rows, names and types."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table, names):
    cols = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*cols), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    a, b = sorted(ours.column_names), sorted(theirs.column_names)
    if a != b:
        return f"columns {a} vs {b}"
    kinds = [
        (n, str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in a
        if str(ours.schema.field(n).type).replace("large_", "") != str(theirs.schema.field(n).type).replace("large_", "")
    ]
    left, right = _rows(ours, a), _rows(theirs, a)
    if left != right:
        in_left, in_right = set(map(repr, left)), set(map(repr, right))
        only = [r for r in left if repr(r) not in in_right][:2]
        other = [r for r in right if repr(r) not in in_left][:2]
        return f"{len(left)} vs {len(right)} rows; {a}; ours only {only}; theirs only {other}; types {kinds}"
    if kinds:
        return f"types {kinds}"
    return None
