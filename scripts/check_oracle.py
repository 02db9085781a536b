"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [query ...]
Comparison: row count, column names, and an order-insensitive hash of the
values (floats rounded to 6 decimals), like the round driver.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tagloom.plans.registry import load_all  # noqa: E402
from tagloom.session import get_session  # noqa: E402
from tagloom.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    reg = load_all()
    ok_all = True
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"{name:28s} rows={len(rows):7d} spark={t1-t0:6.1f}s  (no oracle)")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {str(e)[:400]}")
            ok_all = False
            continue
        t2 = time.time()
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        same = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        ok_all &= same
        print(f"{name:28s} rows={len(rows):7d}/{len(drows):7d} cols={'ok' if sorted(cols)==sorted(dcols) else (cols, dcols)} "
              f"hash={'MATCH' if h1 == h2 else 'DIFF'} spark={t1-t0:6.1f}s duck={t2-t1:6.1f}s")
        if not same:
            s1, s2 = set(l1), set(l2)
            print("   only spark:", sorted(s1 - s2)[:5])
            print("   only duck :", sorted(s2 - s1)[:5])
    print("ALL OK" if ok_all else "SOME FAILED")


if __name__ == "__main__":
    main()
