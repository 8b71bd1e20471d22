"""Run every query against its SQL oracle: python tests/check_oracles.py [sf] [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from arcweave import configure  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql):
    """None if both sides agree on names, types and rows, else what differs."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    types = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    def key(row):
        return tuple((v is None, v if v is not None else 0) for v in row)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    cols = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(relation.project(cols).fetchall(), key=key)
    if ours != theirs:
        odd = [(a, b) for a, b in zip(ours, theirs) if a != b][:3]
        return f"{len(ours)} rows against {len(theirs)}, first differences {odd}"
    return None


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:] or list(driver.oracle_sql())
    spark = (
        configure(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{sf}"
    con = oracle_connection(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(
                driver.queries()[name](spark, sf_dir), con, driver.oracle_sql()[name]
            )
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f} s  {problem or 'ok'}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
