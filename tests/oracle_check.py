"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for v in VIEWS:
        p = os.path.join(sf_dir, f"{v}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    ok = ok_cols and a == b
    detail = ""
    if not ok_cols:
        detail = f"cols spark={sorted(s_cols)} duck={sorted(d_cols)}"
    elif len(a) != len(b):
        detail = f"rows spark={len(a)} duck={len(b)}"
    elif a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        detail = f"first diffs: {diffs}"
    return ok, len(s_rows), round(t1 - t0, 2), detail


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    from tripkit.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"NO-ORACLE {name}: rows={n}")
            continue
        try:
            ok, n, sec, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            ok, n, sec, detail = False, -1, 0, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: rows={n} t={sec}s {detail}")
    missing = [n for n in sqls if n not in qs]
    if missing:
        print("oracle without query:", missing)
    print(f"{len(names or qs) - bad} ok, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
