"""Staging tables: one keyed table per document type below a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.operators.relational import restrict_to
from chartloom.sources.keyed import KeyedTable

# What an append to a staging table replaces. Documents that are rebuilt whole are replaced by
# entity, with all their parts; the others by document.
ENTITY_KEYS = {
    "encounter": "encounter_id",
    "patient": "person_id",
    "lab_orders": "order_id",
    "labs": "encounter_id",
    "program_enrollment": "patient_program_id",
}


def staging_key(table: str) -> str:
    return ENTITY_KEYS.get(table, "doc_id")


# Tables whose key names the person: these are bucketed by person. An encounter or an order may move to another person, and
# would then be in two buckets, so the others are not.
BY_PERSON = {"patient", "vitals", "hiv_summary"}


def staging_table(spark: SparkSession, root: str, table: str, keys: str | None = None) -> KeyedTable:
    bucket = "person_id" if table in BY_PERSON else None
    return KeyedTable(spark, f"{root.rstrip('/')}/{table}", keys or staging_key(table), bucket_by=bucket)


def read_staging(
    spark: SparkSession, root: str, table: str, keys: str | None = None, people: DataFrame | None = None
) -> DataFrame:
    """Current rows, or those of some people, of which a table bucketed by person opens their buckets only."""
    own = staging_table(spark, root, table, keys)
    if people is None or own.bucket_by:
        return own.read(people)
    return restrict_to(own.read(), people, "person_id")


def upsert_staging(
    df: DataFrame,
    root: str,
    table: str,
    keys: str | None = None,
    writer: str | None = None,
    writer_batch: int | None = None,
) -> bool:
    """Append that replaces rows of the same key; the last write wins."""
    return staging_table(df.sparkSession, root, table, keys).upsert(df, writer, writer_batch)


def replace_staging(df: DataFrame, root: str, table: str, keys: str | None = None, seen: int | None = None) -> None:
    """Full load; ``seen`` is the version of the table before its sources were read."""
    staging_table(df.sparkSession, root, table, keys).replace(df, seen)
