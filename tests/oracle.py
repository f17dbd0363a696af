"""Run registered queries and their SQL side by side: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import threading
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if type(value).__name__ == "Decimal":
        return ("decimal", str(value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, q, sf_dir, limit=120):
    """None when equal, else a short reason. A query that runs past ``limit`` seconds is cancelled."""
    start = time.time()
    timer = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        df = q.build(spark, sf_dir)
        mine = rows_of(df.columns, df.collect())
    finally:
        timer.cancel()
    compare.spark_seconds = time.time() - start
    if q.sql is None:
        return None, len(mine[1])
    cur = con.execute(q.sql)
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(mine[1])
    if mine[1] != theirs[1]:
        extra = [r for r in mine[1] if r not in set(theirs[1])][:2]
        lack = [r for r in theirs[1] if r not in set(mine[1])][:2]
        return f"{len(mine[1])} rows vs {len(theirs[1])}; only spark {extra}; only sql {lack}"[:1500], len(mine[1])
    return None, len(mine[1])


def main() -> int:
    from tidemark.plans.queries import REGISTRY
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    bad = []
    for name, q in sorted(REGISTRY.items()):
        if args and not any(name == a or name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            reason, n = compare(spark, con, q, sf_dir)
        except Exception as exc:  # noqa: BLE001  report every failure
            reason, n = f"{type(exc).__name__}: {str(exc)[:900]}", -1
        mark = "ok " if reason is None else "BAD"
        print(f"{mark} {name:32s} {n:8d} rows  spark {compare.spark_seconds:6.2f}s  all {time.time() - start:6.2f}s {'' if q.sql else '(no sql)'} {reason or ''}", flush=True)
        if reason:
            bad.append(name)
    print(f"{len(bad)} failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
