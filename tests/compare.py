"""Run registered queries against their SQL:  python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, con, folder, query, sql):
    """'' if both engines agree, else a short report; with row count and times."""
    start = time.time()
    df = query(spark, folder)
    got_columns, got = rows_of(df.columns, df.collect())
    middle = time.time()
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    end = time.time()
    report = ""
    if got_columns != want_columns:
        report = f"columns: only spark {set(got_columns) - set(want_columns)}, only sql {set(want_columns) - set(got_columns)}"
    elif got != want:
        extra, missing = got - want, want - got
        report = f"rows: {sum(extra.values())} only in spark, {sum(missing.values())} only in sql"
        if extra and missing:
            a = next(iter(extra))
            b = min(missing, key=lambda m: sum(x != y for x, y in zip(a, m)))
            report += "\n    " + str([(c, x, y) for c, x, y in zip(got_columns, a, b) if x != y][:8]) + f"\n    {a[:3]}"
    return report, sum(got.values()), middle - start, end - middle


def plain_session():
    """A session with stock settings, as a caller may bring it."""
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = plain_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    print("no SQL:", sorted(set(queries) - set(oracle)), "no query:", sorted(set(oracle) - set(queries)))
    for name in names:
        if name not in oracle:
            start = time.time()
            count = len(queries[name](spark, folder).collect())
            print(f"ROWS {name} rows={count} spark={time.time() - start:.1f}s", flush=True)
            continue
        report, count, spark_s, sql_s = difference(spark, con, folder, queries[name], oracle[name])
        bad += bool(report)
        print(f"{'DIFF' if report else 'ok  '} {name} rows={count} spark={spark_s:.1f}s sql={sql_s:.1f}s {report}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
