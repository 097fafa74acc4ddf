"""Order-insensitive comparison of a Spark result with DuckDB's."""

import datetime
import os

import duckdb
import numpy as np

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder=DATA):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "-"
    if isinstance(v, bool | np.bool_):
        return str(bool(v))
    if isinstance(v, int | float | np.number):
        return repr(round(float(v), 9) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def assert_same(df, sql, folder=DATA):
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    c = connect(folder).execute(sql)
    want = rows([d[0] for d in c.description], c.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
