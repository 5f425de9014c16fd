"""Queries of this subpackage and the SQL they must agree with, where SQL can express them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_shipped: set[str] = set()


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def ship(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application, as ``--py-files`` would."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix="chartloom-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(name)
    _shipped.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
