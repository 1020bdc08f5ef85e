"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def compare(spark, con, name, fn, sql, sf_dir):
    """(ok, message) of one query."""
    df = fn(spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, not compared"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != columns:
        return False, f"columns {columns} against {sorted(names)}"
    at = [names.index(c) for c in columns]
    expected = sorted(tuple(_cell(r[i]) for i in at) for r in rel.fetchall())
    if got == expected:
        return len(got) > 0, f"{len(got)} rows equal"
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    return False, f"{len(got)} against {len(expected)} rows, {len(wrong)} differ, e.g. {wrong[:2]}"


def main():
    from tidebars.catalog import registry
    from tidebars.session import get_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--scratch", required=True)
    args = parser.parse_args()
    spark = get_session("oracle", master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g",
                        spark__local__dir=f"{args.scratch}/local", spark__checkpoint__dir=f"{args.scratch}/shared",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    con = connect(args.sf)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            ok, message = compare(spark, con, name, fn, registry.SQL.get(name), args.sf)
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - t:.1f}s {message}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
