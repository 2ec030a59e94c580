"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python scripts/check_oracles.py [sf_dir] [name-prefix ...]
Mirrors the driver's compare: column names sorted, rows order-insensitive.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stockwise.plans.registry import entries  # noqa: E402
from stockwise.session import get_spark  # noqa: E402
from stockwise.sources.tables import TABLE_NAMES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        return str([norm(x) for x in v.tolist()])
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, dict):
        return str(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if hasattr(v, "asDict"):
        return str(v)
    return v if isinstance(v, (int, str, bool)) else str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not a.startswith("/")]
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, e in sorted(entries().items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = e.fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if e.oracle is None:
            print(f"ROWS  {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(e.oracle)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"FAIL  {name}: columns spark={sorted(scols)} oracle={sorted(ocols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        if a == b:
            print(f"OK    {name}: {len(a)} rows ({ts:.1f}s)")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            diff_a = [r for r in a if r not in sb][:3]
            diff_b = [r for r in b if r not in sa][:3]
            print(f"FAIL  {name}: rows spark={len(a)} oracle={len(b)} cols={sorted(scols)}\n"
                  f"      spark-only {diff_a}\n      oracle-only {diff_b}")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
