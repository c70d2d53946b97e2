"""Compare a Spark result with DuckDB's, as multisets of rows.

Run as a script to check all queries: ``python tests/compare.py <sf_dir> [name ...]``.
"""

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else a short report."""
    got = multiset(df.columns, df.collect())
    cursor = con.execute(sql)
    want = multiset([c[0] for c in cursor.description], cursor.fetchall())
    if got == want:
        return None
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    only_got, only_want = got[1] - want[1], want[1] - got[1]
    return (
        f"rows {sum(got[1].values())} vs {sum(want[1].values())}; spark only {sum(only_got.values())}:"
        f" {list(only_got)[:2]}; sql only {list(only_want)[:2]}"
    )


if __name__ == "__main__":
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for setting in filter(None, os.environ.get("COMPARE_CONF", "").split(",")):
        spark.conf.set(*setting.split("=", 1))
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(contract.queries())
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            report = difference(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name])
        except Exception as error:
            report = f"{type(error).__name__}: {str(error)[:600]}"
        bad += report is not None
        print(f"{name:24s} {time.time() - start:6.1f}s  {report or 'ok'}", flush=True)
    print("failed:", bad)
