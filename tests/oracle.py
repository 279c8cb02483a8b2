"""Compare registered queries with their SQL on the same tables.

Run as a script: ``python tests/oracle.py [folder] [query ...]``.
"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def difference(df, con, sql):
    """None if equal, else a short text."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(rel.columns, rel.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(df.columns)}\n   {a}\n   {b}"
    return None


def main(folder="/root/testdata/sf0.01", *names):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    known, expected = queries(), oracle_sql()
    print("without SQL:", sorted(set(known) - set(expected)))
    for name in names or known:
        start = time.time()
        try:
            found = difference(known[name](spark, folder), con, expected[name])
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s",
              "" if found is None else found, flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
