"""Compare a registered query with its DuckDB oracle (row count, columns, values).

Usage: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare floats bit for bit
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from tidemark.plans import catalog
    df = catalog.QUERIES[name](spark, sf_dir)
    scols = sorted(df.columns)
    srows = [tuple(_norm(r[c]) for c in scols) for r in df.collect()]
    res = con.execute(catalog.ORACLE_SQL[name])
    dcols_raw = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    dcols = sorted(dcols_raw)
    idx = [dcols_raw.index(c) for c in dcols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(srows)} rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tidemark.plans import catalog
    from tidemark.session import build_session
    names = sys.argv[2:] or [n for n in catalog.QUERIES if n in catalog.ORACLE_SQL]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    ok_all = True
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}"
        ok_all &= ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    missing = [n for n in catalog.QUERIES if n not in catalog.ORACLE_SQL]
    if missing:
        print("no oracle:", missing)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main())
