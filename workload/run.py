"""Compare registered queries with their oracle SQL: python -m workload.run [sf] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from chartloom.session import with_recommended
from workload import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(rows: list[tuple], columns: list[str]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def main(sf: str, names: list[str]) -> int:
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = with_recommended(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            seconds = time.time() - start
            if name not in ORACLE:
                print(f"rows {name}: {len(got)} rows {seconds:.2f}s", flush=True)
                continue
            result = db.execute(ORACLE[name])
            columns = [c[0] for c in result.description]
            want = result.fetchall()
        except Exception as error:
            failed += 1
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
            continue
        if sorted(columns) != sorted(df.columns):
            failed += 1
            print(f"FAIL {name}: columns {df.columns} and {columns}")
            continue
        a, b = normal(got, df.columns), normal(want, columns)
        if a == b:
            print(f"ok   {name}: {len(a)} rows {seconds:.2f}s", flush=True)
        else:
            failed += 1
            print(f"FAIL {name}: {len(a)} and {len(b)} rows", flush=True)
            for x in sorted(set(a) - set(b))[:2]:
                print("   spark ", x[:1500])
            for x in sorted(set(b) - set(a))[:2]:
                print("   oracle", x[:1500])
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(1 if main(arguments[0] if arguments else "0.01", arguments[1:]) else 0)
