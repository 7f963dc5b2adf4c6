"""Runs a query and its SQL side by side, order aside."""

import datetime
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in rows)


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    got = con.execute(sql)
    return rows_of([c[0] for c in got.description], got.fetchall())


def sparked(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
