"""Run driver queries in Spark and their DuckDB twins; compare results.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Compares row count, column names and an order-insensitive multiset of rows
(floats compared exactly and, separately, rounded to 6 decimals).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits) if digits is not None else v
    if isinstance(v, Decimal):
        return _norm(float(v), digits)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True), digits)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    return v


def rows_of(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["duck_cols"] = sorted(d_cols)
        out["match"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["exact"] = a == b
    a6, b6 = rows_of(s_cols, s_rows, 6), rows_of(d_cols, d_rows, 6)
    out["match"] = a6 == b6
    if not out["match"]:
        only_s = list((a6 - b6).elements())[:3]
        only_d = list((b6 - a6).elements())[:3]
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from ledgerline.session import local_session

    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print({"query": name, "spark_rows": df.count(), "oracle": None}, flush=True)
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls[name], con)
        except Exception as e:  # report and continue
            r = {"query": name, "error": repr(e)[:800], "match": False}
        bad += not r.get("match")
        print(r, flush=True)
    print("MISMATCHES", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
