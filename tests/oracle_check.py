"""Runs queries in Spark and their SQL in DuckDB and compares rows exactly.

Usage: python tests/oracle_check.py SF_DIR [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (0, "") if math.isnan(v) else (2, repr(v + 0.0))
    if isinstance(v, int):
        return (2, repr(v))
    return (3, str(v))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = normalised(names, cur.fetchall())
    got_cols, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}"
    types = {d[0]: str(d[1]) for d in cur.description}
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} vs {b} (types {types})"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
            else:
                problem = None if df.count() >= 0 else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        took = time.perf_counter() - start
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
