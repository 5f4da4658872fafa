"""Run every registered query on Spark and its SQL twin on DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
Compares row count, column names and an order-insensitive multiset of rows.
The session can be varied to check independence from it: CHECK_CORES,
CHECK_SHUFFLE_PARTITIONS, CHECK_TZ.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strata.plans.catalog import oracle_sql, queries  # noqa: E402
from strata.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", repr(float(v)))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if hasattr(v, "tolist"):
        return ("a", tuple(norm(x) for x in v.tolist()))
    if isinstance(v, (list, tuple)):
        return ("a", tuple(norm(x) for x in v))
    return ("s", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = local_session(
        os.environ.get("CHECK_CORES", "8"),
        shuffle_partitions=int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")),
        extra={"spark.sql.session.timeZone": os.environ.get("CHECK_TZ", "UTC")})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        el = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(s_rows)} rows ({el:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(orc[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {e}")
            bad += 1
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and len(a) == len(b) and a == b
        if ok:
            print(f"OK   {name}: {len(a)} rows ({el:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: cols_ok={ok_cols} spark={len(a)} duck={len(b)} ({el:.1f}s)")
            if not ok_cols:
                print("   spark cols", sorted(s_cols), "\n   duck cols ", sorted(d_cols))
            sa, sb = set(a), set(b)
            for r in list(sa - sb)[:3]:
                print("   only spark:", r)
            for r in list(sb - sa)[:3]:
                print("   only duck: ", r)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
