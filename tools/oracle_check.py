"""Run every driver query in Spark and its oracle SQL in DuckDB; compare results.

usage: python tools/oracle_check.py [sf_dir] [name ...]
Order-insensitive: rows are compared as sorted tuples over name-sorted columns; floats
are compared after rounding to 9 significant digits."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stationlink.plans import ORACLE_SQL, QUERIES  # noqa: E402
from stationlink.session import build_session  # noqa: E402
from stationlink.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{n}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if n not in ORACLE_SQL:
            print(f"{n}: rows={len(srows)} (no oracle) {dt:.1f}s")
            continue
        try:
            cur = con.execute(ORACLE_SQL[n])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{n}: DUCKDB ERROR {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        ok = ok_cols and a == b
        bad += not ok
        msg = "OK" if ok else "MISMATCH"
        print(f"{n}: {msg} spark={len(srows)} oracle={len(orows)} {dt:.1f}s")
        if not ok:
            if not ok_cols:
                print("   cols", scols, ocols)
            else:
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark-only", diff_a)
                print("   oracle-only", diff_b)
    print("bad:", bad)


if __name__ == "__main__":
    main()
