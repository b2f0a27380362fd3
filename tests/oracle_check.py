"""Run registered queries against DuckDB and compare.

python tests/oracle_check.py [sf] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def oracle_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return ("f", round(v, 9) + 0.0)
        if hasattr(v, "is_finite"):  # decimal
            return ("f", round(float(v), 9) + 0.0)
        return (type(v).__name__, str(v))

    return [names[i] for i in order], sorted(
        (tuple(value(r[i]) for i in order) for r in rows), key=repr
    )


def compare(df, con, sql):
    """None when equal, else what differs."""
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = normal(*oracle_rows(con, sql))
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        return f"{len(bad)} rows differ, first {bad[0]} (columns {got_names})"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                n = len(oracle_rows(con, sqls[name])[1])
            else:
                problem, n = None, df.count()
        except Exception:
            problem, n = traceback.format_exc()[-1500:], 0
        failed += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:38s} {n:8d} {time.time() - t:6.1f}s", flush=True)
        if problem:
            print("     ", problem, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
