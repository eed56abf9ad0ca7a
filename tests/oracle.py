"""Run a registered query in Spark and its twin in DuckDB and compare them value by value."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = [tuple(_norm(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(data, key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r))


def compare(spark, con, query, folder):
    """None if equal, else a text that says what differs."""
    frame = query.run(spark, folder)
    s_names, s_rows = _table(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(query.sql)
    d_names, d_rows = _table([d[0] for d in result.description], result.fetchall())
    if s_names != d_names:
        return f"columns {s_names} vs {d_names}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} vs {len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            differing = sum(1 for x, y in zip(s_rows, d_rows) if x != y)
            return f"{differing} rows differ, first {a} vs {b}"
    return None
