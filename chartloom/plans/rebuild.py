"""Full rebuild of the staging tables, first load and nightly sync of the target databases."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column
from chartloom.operators.relational import ensure_build_date, missing_from, restrict_to, rows_of_entities_seen_at
from chartloom.operators.sync import classify, cohorts, leavers, stale_parts, tombstones
from chartloom.plans import dimensions as dim
from chartloom.plans.encounters import encounter_documents
from chartloom.plans.lab_orders import lab_order_documents
from chartloom.plans.observations import obs_documents
from chartloom.plans.patients import patient_documents
from chartloom.plans.summaries import (
    hiv_summary_documents,
    labs_documents,
    program_documents,
    vitals_documents,
)
from chartloom.plans.target import to_target
from chartloom.session import temporary_folders, written
from chartloom.sources.documents import DB, read_manifest, write_documents
from chartloom.sources.keyed import KeyedTable
from chartloom.sources.staging import BY_PERSON, read_staging, replace_staging, staging_table

PATIENT_TABLE = "patient"


def location_db(location: ColumnOrName = "location_id") -> Column:
    """Name of the database of a location."""
    return F.concat(F.lit("location-"), as_column(location).cast("string"))


def document_jobs(
    tables: dim.Tables, as_of: Column, built_at: Column | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The staging tables and how each is built; nothing is built before its turn.

    Of vitals and HIV summaries all rows are staged; a target takes the latest ones.
    """

    def encounters() -> DataFrame:
        obs = obs_documents(tables["obs"], dim.concepts(tables), dim.drugs(tables), by="encounter_id")
        return encounter_documents(tables, obs, built_at)

    def labs() -> DataFrame:
        return labs_documents(
            tables["flat_labs_and_imaging"], tables["encounter"], tables["flat_hiv_summary"], built_at=built_at
        )

    return {
        "patient": lambda: patient_documents(tables["patient_view"], as_of, built_at),
        "vitals": lambda: vitals_documents(tables["flat_vitals"], built_at),
        "hiv_summary": lambda: hiv_summary_documents(tables["flat_hiv_summary"], built_at),
        "program_enrollment": lambda: program_documents(tables["program_enrollment_view"], built_at),
        "encounter": encounters,
        "lab_orders": lambda: lab_order_documents(tables, built_at),
        "labs": labs,
    }


def rebuild_all(
    jobs: Mapping[str, Callable[[], DataFrame]], root: str, built_at: Column | None = None, spark: SparkSession | None = None
) -> None:
    """Build every document table and make it the new base of its staging table."""
    spark = spark or SparkSession.active()
    for table, build in jobs.items():
        # What streams append from here on is newer than what the build reads.
        seen = staging_table(spark, root, table).version()
        replace_staging(ensure_build_date(build(), built_at), root, table, seen=seen)


def initial_load(table: str, staged: DataFrame, members: DataFrame, location_id: object) -> DataFrame:
    """Documents a new database starts with.

    Patients of the cohort; of other tables everything about those cohort patients who have at
    least one row at the location.
    """
    docs = restrict_to(staged, members, "person_id", measure=True)
    if table != PATIENT_TABLE:
        docs = rows_of_entities_seen_at(docs, "person_id", F.col("location_id") == location_id)
    return to_target(table, docs)


def addressed(table: str, staged: DataFrame, members: DataFrame) -> DataFrame:
    """Target documents with the database they belong to, for cohorts of any number of locations."""
    where = members.select("person_id", location_db().alias(DB)).distinct()
    docs = to_target(table, restrict_to(staged, where, "person_id", measure=True))
    return docs.join(where, "person_id")


def changed_documents(table: str, staged: DataFrame, members: DataFrame, manifest: DataFrame) -> DataFrame:
    """What a sync writes for one table: new and changed documents, and parts no longer there."""
    docs = addressed(table, staged, members)
    compared = classify(docs, manifest, "_id", on=[DB])
    news = compared.where(F.col("status") != "unchanged").drop("status")
    gone = stale_parts(manifest, docs, on=[DB]).select("_id", "_rev", DB, "person_id", "_deleted")
    return news.unionByName(gone, allowMissingColumns=True)


def last_cohorts(spark: SparkSession, target_root: str, table: str) -> KeyedTable:
    """Whom the last nightly run of a table wrote for; its note names the version of staging that the run had read."""
    return KeyedTable(spark, f"{target_root.rstrip('/')}/_nightly/{table}", ["person_id", "location_id"])


def touched_members(spark: SparkSession, staging_root: str, table: str, members: DataFrame, last: KeyedTable) -> DataFrame:
    """Members whose documents changed in staging since the last run, and those who were not members then.

    Staging names the keys it changed (``changes_since``), so unchanged documents are neither read nor compared.
    """
    if not last.exists():
        return members
    joined = missing_from(members, last.read(), ["person_id", "location_id"])
    own = staging_table(spark, staging_root, table)
    changed = own.changes_since(last.note()["version"])
    if changed is None:
        return members
    if "person_id" not in changed.columns:
        changed = restrict_to(own.read().select(*own.keys, "person_id"), changed, own.keys)
    return joined.unionByName(restrict_to(members, changed.select("person_id").distinct(), "person_id")).distinct()


def nightly_upsert(
    spark: SparkSession, staging_root: str, target_root: str, summary: DataFrame, date: Column, tables: Sequence[str]
) -> None:
    """Bring the databases of all locations up to date with staging: changed documents, and those of new members."""
    with temporary_folders(spark):
        members = written(cohorts(summary, date), "cohorts")
        for table in tables:
            version = staging_table(spark, staging_root, table).version()
            last = last_cohorts(spark, target_root, table)
            touched = written(touched_members(spark, staging_root, table, members, last), "touched")
            if not touched.isEmpty():
                people = touched.select("person_id").distinct()
                staged = read_staging(spark, staging_root, table, people=people)
                manifest = read_manifest(spark, target_root, people=people if table in BY_PERSON else None)
                write_documents(changed_documents(table, staged, touched, manifest), target_root)
            # The place moves on behind the write; a run that fails before is done again.
            last.replace(members, note={"version": version})


def leaver_tombstones(manifest: DataFrame, summary: DataFrame, today: Column, yesterday: Column) -> DataFrame:
    """Removals for patients who left the cohort of a location since yesterday."""

    def members(date: Column) -> DataFrame:
        return cohorts(summary, date).select("person_id", location_db().alias(DB))

    left = leavers(members(yesterday), members(today), ["person_id", DB])
    return tombstones(manifest, left, ["person_id", DB])


def nightly_delete(
    spark: SparkSession, target_root: str, summary: DataFrame, today: Column, yesterday: Column
) -> None:
    """Remove the documents of leavers from the databases of all locations."""
    manifest = read_manifest(spark, target_root)
    write_documents(leaver_tombstones(manifest, summary, today, yesterday), target_root)
