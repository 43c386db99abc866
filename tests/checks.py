"""Compare a query with its SQL on the same tables."""

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(picked, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark, con, run, sql, sf_dir):
    """Differences as text, '' if there are none, and both run times."""
    started = time.time()
    df = run(spark, sf_dir)
    got = df.collect()
    spark_time = time.time() - started
    started = time.time()
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    sql_time = time.time() - started
    columns, rows = _sorted_rows(df.columns, [tuple(r) for r in got])
    want_columns, want_rows = _sorted_rows(want_columns, want)
    times = (spark_time, sql_time, len(rows))
    if columns != want_columns:
        return f"columns {columns} != {want_columns}", times
    if len(rows) != len(want_rows):
        extra, missing = set(rows) - set(want_rows), set(want_rows) - set(rows)
        return f"{len(rows)} != {len(want_rows)} rows; {list(extra)[:2]} {list(missing)[:2]}", times
    differ = [(a, b) for a, b in zip(rows, want_rows) if a != b]
    if differ:
        return f"{len(differ)} of {len(rows)} rows differ: {differ[0]}"[:1500], times
    return "", times
