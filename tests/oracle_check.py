"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [q_name ...]

Comparison mirrors the driver's: columns sorted by name, row count, and an
order-insensitive multiset of normalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    s_sorted, scols = rows_of(sdf.columns, srows)
    d_sorted, dcols_sorted = rows_of(dcols, drows)
    ok = scols == dcols_sorted and len(srows) == len(drows) and s_sorted == d_sorted
    detail = ""
    if scols != dcols_sorted:
        detail = f"columns spark={scols} duck={dcols_sorted}"
    elif len(srows) != len(drows):
        detail = f"rows spark={len(srows)} duck={len(drows)}"
    elif not ok:
        diff_s = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted if r not in set(s_sorted)][:3]
        detail = f"values differ; spark-only {diff_s} duck-only {diff_d}"
    return ok, len(srows), t1 - t0, t2 - t1, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and not argv[1].startswith("q_") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if a.startswith("q_")]
    import __spark_entry__ as entry
    from sparkmart.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in sorted(qs):
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:32s} NO-ORACLE")
            continue
        try:
            ok, n, ts, td, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            ok, n, ts, td, detail = False, -1, 0, 0, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        failures += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={n:<7d} spark={ts:6.2f}s duck={td:5.2f}s {detail}", flush=True)
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
