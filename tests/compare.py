"""Runs registered queries next to their SQL in DuckDB and compares the rows.

    python -m tests.compare [--sf DIR] [--zone ZONE] [NAME ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value).hex()
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=repr)


def kind(value) -> str:
    if isinstance(value, str):
        return "str"
    return type(value).__name__


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours_names = df.columns
    ours_raw = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs_raw = cursor.fetchall()
    if sorted(ours_names) != sorted(names):
        return f"columns {sorted(ours_names)} vs {sorted(names)}"
    for i, name in enumerate(ours_names):
        a = next((r[i] for r in ours_raw if r[i] is not None), None)
        b = next((r[names.index(name)] for r in theirs_raw if r[names.index(name)] is not None), None)
        if a is not None and b is not None and kind(a) != kind(b):
            return f"type of {name}: {kind(a)} vs {kind(b)}"
    ours, theirs = rows_of(ours_names, ours_raw), rows_of(names, theirs_raw)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row {a!r}\n  vs {b!r}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--zone", default="UTC", help="session time zone")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.session import local_session

    assert glob.glob(f"{args.sf}/*.parquet"), args.sf
    spark = local_session()
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    con = duck(args.sf)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        begin = time.time()
        try:
            df = fn(spark, args.sf)
            if name in oracle:
                problem = difference(df, con, oracle[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, state = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = state = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - begin:6.2f}s {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
