"""Run a query on Spark and its SQL on DuckDB and compare the full results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def ordered(names, rows):
    place = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in place) for r in rows]
    return sorted(names), sorted(out, key=repr)


def spark_result(df):
    return ordered(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return ordered([d[0] for d in cur.description], cur.fetchall())
