"""Run queries() in Spark and oracle_sql() in DuckDB on the same tables and compare.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    # doubles are compared exactly: the report ratios are bit-identical in both engines
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(spark_dtypes, duck_cols, duck_types):
    d = dict(zip(duck_cols, [str(t) for t in duck_types]))
    return [(c, t, d.get(c)) for c, t in spark_dtypes if SPARK_TO_DUCK.get(t, t) != d.get(c)]


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs = E.queries()
    sql = E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(sql):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sql:
            results[name] = ("no-oracle", len(s_rows))
            if verbose:
                print(f"{name:28s} rows={len(s_rows)} (no oracle) {t1-t0:.1f}s", flush=True)
            continue
        rel = con.sql(sql[name])
        d_cols = rel.columns
        d_rows = rel.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        bad_types = type_mismatches(df.dtypes, d_cols, rel.types) if ok_cols else []
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and not bad_types and a == b
        results[name] = ("ok" if ok else "MISMATCH", len(s_rows), len(d_rows))
        if verbose:
            print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={len(s_rows)} duck={len(d_rows)} {t1-t0:.1f}s", flush=True)
            if not ok_cols:
                print("   cols spark", sorted(s_cols), "\n   cols duck ", sorted(d_cols))
            elif bad_types:
                print("   types", bad_types)
            elif not ok:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck :", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from viewpulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("MISMATCHES:", bad)
