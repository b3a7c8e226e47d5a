"""Run catalogue queries on Spark and their oracle SQL on DuckDB; compare
row count, column names and an order-insensitive hash of rounded values.

    python tools/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from panelspark.plans import catalog  # noqa: E402
from panelspark.sources.bindings import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    from panelspark.session import build_session
    spark = build_session()
    catalog.load_all()
    con = duck(sf_dir)
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception:
            bad += 1
            print(f"FAIL {name}: spark error\n{traceback.format_exc()[-2500:]}")
            continue
        ts = time.time() - t0
        sql = catalog.ORACLE.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as exc:
            bad += 1
            print(f"FAIL {name}: duckdb error {exc}")
            continue
        if sorted(scols) != sorted(dcols):
            bad += 1
            print(f"FAIL {name}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        if len(srows) != len(drows) or hs != hd:
            bad += 1
            only_s = sorted(set(ls) - set(ld))[:3]
            only_d = sorted(set(ld) - set(ls))[:3]
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)} cols={sorted(scols)}\n  spark-only {only_s}\n  duck-only  {only_d}")
        else:
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
