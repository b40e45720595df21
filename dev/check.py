"""Run registered queries beside their SQL checks in DuckDB and compare the values.

    python dev/check.py [--sf DIR] [name or part of a name ...]
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from millrace.catalog import CHECKS, QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{plain(v)}" for k, v in value.items()) + "}"
    return str(value)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(plain(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--exact", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad, slow = [], []
    for name, run in QUERIES.items():
        if args.names and not any((n == name) if args.exact else (n in name) for n in args.names):
            continue
        began = time.time()
        try:
            df = run(spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"ERROR  {name}: {str(error)[:700]}", flush=True)
            continue
        took = time.time() - began
        slow.append((took, name))
        if name not in CHECKS:
            print(f"rows   {name}: {len(rows)} rows, {took:.1f}s {[f'{c}:{t}' for c, t in df.dtypes][:6]}", flush=True)
            if not rows:
                bad.append(name)
            continue
        try:
            cursor = db.execute(CHECKS[name])
            columns = [d[0] for d in cursor.description]
            kinds = [str(d[1]) for d in cursor.description]
            wanted = cursor.fetchall()
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"SQLERR {name}: {str(error)[:700]}", flush=True)
            continue
        sql_took = time.time() - began - took
        mine, a = digest(df.columns, rows)
        theirs, b = digest(columns, wanted)
        if sorted(columns) == sorted(df.columns) and mine == theirs and rows:
            print(f"ok     {name}: {len(rows)} rows, {took:.1f}s (sql {sql_took:.1f}s)", flush=True)
        else:
            bad.append(name)
            print(f"DIFF   {name}: {len(rows)} vs {len(wanted)} rows; {df.dtypes} vs {list(zip(columns, kinds))}", flush=True)
            only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
            print(f"   {len(only_a)} only spark {only_a[:3]}\n   {len(only_b)} only sql {only_b[:3]}", flush=True)
    print("slowest:", [(f"{t:.1f}", n) for t, n in sorted(slow, reverse=True)[:12]])
    print("total:", f"{sum(t for t, _ in slow):.0f}s", "bad:", bad)


if __name__ == "__main__":
    main()
