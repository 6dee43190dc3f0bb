"""Run catalogue queries on Spark and their SQL on DuckDB and compare results.

Used by the test suite and runnable by hand:
    python tests/oracle.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from metrolens.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", str(x)) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=_key)


def compare(spark, con, key, sf_dir, builder, sql):
    t0 = time.time()
    df = builder(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_names, s_vals = rows_of(s_cols, s_rows)
    d_names, d_vals = rows_of(d_cols, d_rows)
    problems = []
    if s_names != d_names:
        problems.append(f"columns {s_names} vs {d_names}")
    if len(s_vals) != len(d_vals):
        problems.append(f"rows {len(s_vals)} vs {len(d_vals)}")
    elif s_vals != d_vals:
        diff = [(a, b) for a, b in zip(s_vals, d_vals) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_vals), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from metrolens.catalog import ORACLE_SQL, QUERIES
    from metrolens.session import build_session

    spark = build_session("local[8]")
    con = duck(sf_dir)
    keys = argv[2:] or list(QUERIES)
    bad = 0
    for key in keys:
        sql = ORACLE_SQL.get(key)
        try:
            if sql is None:
                t0 = time.time()
                n = QUERIES[key](spark, sf_dir).count()
                print(f"{key:26s} rows-only  {n:7d} rows  {time.time() - t0:6.2f}s")
                continue
            problems, n, secs = compare(spark, con, key, sf_dir, QUERIES[key], sql)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{key:26s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        status = "ok" if not problems else "MISMATCH " + "; ".join(problems)
        bad += bool(problems)
        print(f"{key:26s} {n:7d} rows {secs:6.2f}s  {status}")
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
