"""Every registered query against its oracle SQL, on the smallest test tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from workload.run import TABLES, normal  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_agrees_with_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    want = normal(result.fetchall(), columns)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want, strict=True) if a != b][:2] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
