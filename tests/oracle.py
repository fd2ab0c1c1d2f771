"""Compare registered queries with their SQL twins.  ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return ""
        v = round(v, 6)
        return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, con, sf: str, name: str, build, sql: str | None):
    t = time.time()
    df = build(spark, sf)
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    if sql is None:
        return "rows-only", len(got), took, ""
    cur = con.execute(sql)
    want_names, want = rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return "SCHEMA", len(got), took, f"{got_names} != {want_names}"
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return "DIFF", len(got), took, f"{len(got)} vs {len(want)} rows; spark {extra[:3]} sql {missing[:3]}"
    return "ok", len(got), took, ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from cantus.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if only and name not in only:
            continue
        try:
            status, n, took, note = compare(spark, con, sf, name, build, oracles.get(name))
        except Exception as exc:  # report and go on
            status, n, took, note = "ERROR", -1, 0.0, f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += status not in ("ok", "rows-only")
        print(f"{status:10s} {name:32s} rows={n:<8d} {took:6.2f}s {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
