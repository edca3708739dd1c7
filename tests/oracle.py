"""Comparison of a query's rows with DuckDB's."""

import datetime
import decimal
import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connect(sf_dir):
    c = duckdb.connect()
    for name in os.listdir(sf_dir):
        c.sql(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    return c


def _value(x):
    if x is None:
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (float, decimal.Decimal)):
        return "nan" if math.isnan(x) else repr(round(float(x), 6) + 0.0)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(_value, x)) + "]"
    return str(x)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_value(r[i]) for i in order) for r in rows)


def check(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    want = connect(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)
