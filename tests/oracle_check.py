"""Run registered queries and their SQL side by side: python tests/oracle_check.py SF_DIR [NAME ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from pagegraph.plans.oracles import ORACLES
from pagegraph.plans.registry import QUERIES


def connect(sf_dir):
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def rows_of(columns, rows):
    """Rows as sorted tuples with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def expected(con, name):
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def actual(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = builder.config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        got = actual(spark, sf_dir, name)
        took = time.time() - start
        want = expected(con, name)
        print(f"{'ok  ' if got == want else 'DIFF'} {name:24s} {len(got[1]):8d} rows {took:6.2f} s", flush=True)
        if got != want:
            print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            mine, theirs = set(map(repr, got[1])), set(map(repr, want[1]))
            print("   only spark ", [r[:400] for r in sorted(mine - theirs)[:3]])
            print("   only oracle", [r[:400] for r in sorted(theirs - mine)[:3]])
    spark.stop()
