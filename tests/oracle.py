"""Runs a query and its SQL side by side and compares rows without regard to order."""

import datetime
import decimal
import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"create view {os.path.basename(path).split('.')[0]} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def compare(con, spark, query, sql, folder):
    df = query(spark, folder)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    at = [columns.index(n) for n in names]
    want = sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
    assert got == want, (set(got) ^ set(want)).__iter__().__next__() if set(got) ^ set(want) else "repeated rows differ"
