"""Cohorts of patients and the comparison of staged with stored documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.columns import as_list
from chartloom.functions.dates import in_return_window
from chartloom.operators.relational import missing_from, restrict_to

PART_MARK = "#"


def cohorts(
    summary: DataFrame, date: Column, person: str = "person_id", location: str = "location_id", due: str = "rtc_date"
) -> DataFrame:
    """Patients due around the date, by location: one pass for all locations."""
    return summary.where(in_return_window(due, date)).select(location, person).distinct()


def cohort(
    summary: DataFrame,
    date: Column,
    location_id: object,
    person: str = "person_id",
    location: str = "location_id",
    due: str = "rtc_date",
) -> DataFrame:
    """Patients due around the date at one location."""
    here = summary.where(F.col(location) == location_id)
    return here.where(in_return_window(due, date)).select(person).distinct()


def classify(
    docs: DataFrame,
    manifest: DataFrame,
    doc_id: str = "doc_id",
    on: Sequence[str] = (),
    build_date: str = "build_date",
) -> DataFrame:
    """Compare documents with the manifest of what is stored.

    Adds ``_rev`` and ``status``: *insert* where the key is not stored, *update* where the stored
    build date differs, else *unchanged*. A stored document without build date is left alone.
    ``on`` names further key columns both sides have, such as the database.
    """
    stored = manifest.select(
        F.col("_id").alias("__id"),
        F.col("_rev"),
        F.col(build_date).alias("__stored_date"),
        *[F.col(c).alias(f"__on_{c}") for c in on],
    )
    same = [F.col(doc_id) == F.col("__id"), *[F.col(c) == F.col(f"__on_{c}") for c in on]]
    status = (
        F.when(F.col("__id").isNull(), F.lit("insert"))
        .when(F.col(build_date) != F.col("__stored_date"), F.lit("update"))
        .otherwise(F.lit("unchanged"))
    )
    joined = docs.drop("_rev").join(stored, same, "left").withColumn("status", status)
    return joined.drop("__id", "__stored_date", *[f"__on_{c}" for c in on])


def leavers(yesterday: DataFrame, today: DataFrame, on: str | Sequence[str] = "person_id") -> DataFrame:
    return missing_from(yesterday, today, on)


def joiners(today: DataFrame, manifest: DataFrame, on: str | Sequence[str] = "person_id") -> DataFrame:
    return missing_from(today, manifest, on)


def tombstones(manifest: DataFrame, left: DataFrame, on: str | Sequence[str] = "person_id") -> DataFrame:
    """Stored documents of patients who left, marked for removal."""
    return restrict_to(manifest, left, on).withColumn("_deleted", F.lit(True))


def stale_parts(manifest: DataFrame, docs: DataFrame, doc_id: str = "_id", on: Sequence[str] = ()) -> DataFrame:
    """Stored continuation parts of documents that now have fewer parts, marked for removal."""
    base = F.substring_index("_id", PART_MARK, 1)
    parts = manifest.where(F.col("_id").contains(PART_MARK)).withColumn("__base", base)
    ids = docs.select(F.col(doc_id).alias("_id"), *on)
    bases = ids.withColumn("__base", base).drop("_id").distinct()
    gone = missing_from(restrict_to(parts, bases, ["__base", *on]), ids, ["_id", *on])
    return gone.drop("__base").withColumn("_deleted", F.lit(True))


def attach_rev(docs: DataFrame, manifest: DataFrame, doc_id: str = "_id") -> DataFrame:
    """Documents with the stored revision they replace; NULL for new ones."""
    stored = manifest.select(F.col("_id").alias(doc_id), "_rev")
    return docs.drop("_rev").join(stored, doc_id, "left")


def documents_of(
    docs: DataFrame, members: DataFrame, person: str | Sequence[str] = "person_id"
) -> DataFrame:
    """Documents of the patients in a cohort."""
    return restrict_to(docs, members, as_list(person))
