"""Run registered queries next to their check SQL: python -m testbed.check [folder] [names...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in records)


def main(folder: str, names: list[str]) -> int:
    import duckdb

    from tenderline.session import build_session
    from testbed.queries import REGISTRY

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name, (run, check) in REGISTRY.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            got = rows_of(df.columns, df.collect())
        except Exception as e:
            bad += 1
            print("FAIL", name, str(e)[:600], flush=True)
            continue
        took = time.time() - start
        if check is None:
            print(f"rows {name} {len(got)} {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            cur = con.execute(check)
            want_columns = [d[0] for d in cur.description]
            want = rows_of(want_columns, cur.fetchall())
        except Exception as e:
            bad += 1
            print("SQL", name, str(e)[:600], flush=True)
            continue
        took2 = time.time() - start
        same = got == want and sorted(df.columns) == sorted(want_columns)
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(got)}/{len(want)} {took:.1f}s sql {took2:.1f}s", flush=True)
        if not same:
            a, b = set(got), set(want)
            print("  columns", sorted(df.columns), sorted(want_columns) if sorted(df.columns) != sorted(want_columns) else "")
            print("  only spark", len(a - b), sorted(a - b)[:2])
            print("  only sql  ", len(b - a), sorted(b - a)[:2])
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    raise SystemExit(main(args[0] if args else "/root/testdata/sf0.001", args[1:]))
