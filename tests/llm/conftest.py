from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from chartloom.llm.registry import ship


@pytest.fixture(autouse=True, scope="session")
def shipped(spark: SparkSession):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Documents of (id, text), with the columns of the table and one whose name operators use inside."""

    def make(*rows, parts=3):
        data = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, version string").repartition(parts)

    return make


@pytest.fixture(scope="session")
def alike_words():
    """Two different words of 1,024 bytes whose polynomial sums modulo 2**64 are equal for any odd base."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
