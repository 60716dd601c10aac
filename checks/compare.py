"""Run registered queries in Spark and DuckDB on the same files and compare the rows.

    python -m checks.compare [--sf /root/testdata/sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool) or value is None or isinstance(value, (int, str, dt.date)):
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.14g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, query, sql: str | None) -> str | None:
    """None when equal, else a short account of the difference."""
    df = query(spark, sf_dir)
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if not got:
        return "no rows"
    if sql is None:
        return None
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} / {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}\n  spark  {a}\n  duckdb {b}"
    return None


def main() -> None:
    from basketflow.session import build_session
    from checks import registry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name, query in registry.QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, args.sf, query, registry.ORACLES.get(name))
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "" if name in registry.ORACLES else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{mark} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
