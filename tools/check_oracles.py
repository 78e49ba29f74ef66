"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracles.py [SF_DIR] [name-substring ...]

Comparison mirrors the driver: columns sorted by name, rows compared as an
order-insensitive multiset of values.  ``exact`` means identical values;
``close`` means equal after rounding floats to 6 significant digits.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cauce.session import get_session  # noqa: E402
from cauce.sources.tables import TABLES  # noqa: E402
from cauce.plans.registry import all_oracles, all_queries  # noqa: E402


def norm(v, close):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if close:
            return float(f"{v:.6g}")
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, close) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, close)) for k, x in v.items()))
    return v


def rows_of(cols, records, close):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], close) for i in order) for r in records]
    return sorted(out, key=lambda r: repr(r))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = get_session(os.environ.get("CHECK_MASTER", "local[8]"), shuffle_partitions=8)
    con = duckdb.connect()
    for tname in TABLES:
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{sf}/{tname}.parquet')")
    qs, sqls = all_queries(), all_oracles()
    names = [n for n in sorted(qs) if not pats or any(p in n for p in pats)]
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, sf)
            cols = df.columns
            recs = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL-SPARK {n}: {type(e).__name__}: {str(e)[:300]}")
            traceback.print_exc(limit=3)
            continue
        ts = time.time() - t0
        if n not in sqls:
            print(f"rows-only  {n}: {len(recs)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[n])
            dcols = [d[0] for d in cur.description]
            drecs = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL-SQL   {n}: {str(e)[:400]}")
            continue
        if sorted(cols) != sorted(dcols):
            bad += 1
            print(f"SCHEMA     {n}: spark={sorted(cols)} duck={sorted(dcols)}")
            continue
        a, b = rows_of(cols, recs, False), rows_of(dcols, drecs, False)
        if a == b:
            print(f"exact      {n}: {len(recs)} rows ({ts:.1f}s)")
            continue
        a2, b2 = rows_of(cols, recs, True), rows_of(dcols, drecs, True)
        if a2 == b2:
            print(f"close      {n}: {len(recs)} rows ({ts:.1f}s)")
            continue
        bad += 1
        print(f"MISMATCH   {n}: spark {len(recs)} rows, duck {len(drecs)} rows")
        sa, sb = set(a2), set(b2)
        for r in list(sa - sb)[:3]:
            print("   spark-only", str(r)[:300])
        for r in list(sb - sa)[:3]:
            print("   duck-only ", str(r)[:300])
    print(f"checked {len(names)}, problems {bad}")


if __name__ == "__main__":
    main()
