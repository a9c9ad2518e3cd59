"""Compare a query with its SQL twin: columns, row count and values."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    rows = [tuple(r) for r in df.collect()]
    names, ours = _table(df.columns, rows)
    con.execute(sql)
    wanted_names, theirs = _table([d[0] for d in con.description], con.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    unlike = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unlike)} of {len(ours)} rows differ, e.g. {unlike[0]}" if unlike else None
