"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

As a script: ``python tests/compare.py [scale folder] [query ...]``.
"""

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def as_counter(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
KINDS |= {"boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, sf_dir, name, query, sql):
    """Difference as text, empty when both agree in names, types and rows."""
    frame = query(spark, sf_dir)
    got = as_counter(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = as_counter(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"{name}: columns {sorted(frame.columns)} and {sorted(names)}"
    types = {n: t for n, t, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {n: (t, types[n]) for n, t in frame.dtypes if KINDS.get(t) != types[n]}
    if wrong:
        return f"{name}: types {wrong}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{name}: {sum(extra.values())} extra {list(extra)[:3]}, "
            f"{sum(lacking.values())} lacking {list(lacking)[:3]}"
        )
    return ""


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if name not in sql or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, query, sql[name])
        except Exception as error:  # the report should cover every query
            problem = f"{name}: {type(error).__name__}: {str(error)[:4000]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
