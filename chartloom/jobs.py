"""Jobs for spark-submit.

    spark-submit chartloom/jobs.py rebuild    --source DIR --staging DIR
    spark-submit chartloom/jobs.py metadata   --source DIR --target DIR
    spark-submit chartloom/jobs.py first-load --source DIR --staging DIR --target DIR --location 3 --date 2020-01-31
    spark-submit chartloom/jobs.py nightly    --source DIR --staging DIR --target DIR --date 2020-01-31
    spark-submit chartloom/jobs.py stream vitals --source DIR --staging DIR --checkpoint DIR --inbox DIR

The source is a folder of parquet tables or, with ``--jdbc``, a database. A stream reads a folder
(``--inbox``) or Kafka (``--servers`` and ``--topic``); with ``--target`` it also syncs the databases.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.operators.sync import cohort
from chartloom.plans import dimensions as dim
from chartloom.plans.rebuild import (
    document_jobs,
    initial_load,
    location_db,
    nightly_delete,
    nightly_upsert,
    rebuild_all,
)
from chartloom.plans.summaries import hiv_summary_documents, vitals_documents
from chartloom.session import with_recommended
from chartloom.sources.changes import read_file_changes, read_kafka_changes
from chartloom.sources.documents import read_manifest, write_documents
from chartloom.sources.staging import read_staging
from chartloom.sources.tables import JdbcTables, ParquetTables, SourceTables, Stride
from chartloom.streaming import jobs as stream_jobs
from chartloom.streaming.changes import after_image
from chartloom.streaming.parse import parse_encounters, parse_hiv_summary, parse_vitals

# Names of the source tables.
TABLES = """
    concept concept_name drug encounter encounter_provider encounter_type flat_hiv_summary
    flat_labs_and_imaging flat_vitals form location obs order_type orders patient patient_identifier
    patient_view person person_name program program_enrollment_view provider visit visit_type
""".split()

# Tables that are read from a database in ranges of a key.
KEYS = {
    "encounter": "encounter_id",
    "encounter_provider": "provider_id",
    "flat_hiv_summary": "encounter_id",
    "flat_labs_and_imaging": "encounter_id",
    "flat_vitals": "person_id",
    "obs": "encounter_id",
    "orders": "encounter_id",
    "patient": "patient_id",
    "patient_identifier": "patient_id",
    "patient_view": "person_id",
    "person": "person_id",
    "person_name": "person_id",
    "program_enrollment_view": "person_id",
    "provider": "provider_id",
    "visit": "visit_id",
}

METADATA_DB = "metadata"
SYNCED = ["patient", "encounter", "vitals", "hiv_summary", "program_enrollment", "lab_orders", "labs"]

# Envelope name (or a part of it) and row schema of every change topic.
TOPICS: dict[str, tuple[str, T.StructType]] = {
    "encounter": (".encounter.", schemas.ENCOUNTER_CHANGE),
    "vitals": ("vitals", schemas.VITALS_CHANGE),
    "hiv_summary": ("hiv_summary", schemas.HIV_SUMMARY_CHANGE),
    "lab_orders": (".orders.", schemas.ORDER_CHANGE),
    "labs": ("labs", schemas.LAB_CHANGE),
    "patient": ("person", schemas.PERSON_CHANGE),
    "program_enrollment": ("patient_program", schemas.PROGRAM_ENROLLMENT_CHANGE),
}


def source_tables(spark: SparkSession, arguments: argparse.Namespace) -> SourceTables:
    if not arguments.jdbc:
        return SourceTables(spark, ParquetTables(arguments.source), TABLES)
    strides = {t: Stride(key, 1, arguments.highest_key, arguments.ranges) for t, key in KEYS.items()}
    options = dict(o.split("=", 1) for o in arguments.option)
    return SourceTables(spark, JdbcTables(arguments.jdbc, options, strides), TABLES)


def day(value: date) -> Column:
    return F.lit(value)


def stream_job(topic: str, tables: SourceTables, staging: stream_jobs.Staging) -> stream_jobs.BatchFunction:
    """What is done with a batch of a topic."""
    keys = ["person_id", "encounter_id"]
    if topic == "vitals":
        return stream_jobs.direct(staging, keys, lambda rows: vitals_documents(parse_vitals(rows)))
    if topic == "hiv_summary":
        return stream_jobs.direct(staging, keys, lambda rows: hiv_summary_documents(parse_hiv_summary(rows)))
    builders = {
        "encounter": lambda: stream_jobs.encounters_of(tables, parse_encounters),
        "lab_orders": lambda: stream_jobs.lab_orders_of(tables),
        "labs": lambda: stream_jobs.labs_of(
            tables["flat_labs_and_imaging"], tables["encounter"], tables["flat_hiv_summary"]
        ),
        "patient": lambda: stream_jobs.patients_of(tables["patient_view"], F.current_date()),
        "program_enrollment": lambda: stream_jobs.programs_of(tables["program_enrollment_view"]),
    }
    return stream_jobs.rebuild(staging, builders[topic]())


def changes(spark: SparkSession, arguments: argparse.Namespace) -> DataFrame:
    if arguments.inbox:
        return read_file_changes(spark, arguments.inbox, arguments.per_trigger)
    return read_kafka_changes(spark, arguments.servers, arguments.topic, arguments.per_trigger)


def run(spark: SparkSession, arguments: argparse.Namespace) -> None:
    tables = source_tables(spark, arguments)
    today = day(arguments.date)
    if arguments.job == "rebuild":
        jobs = document_jobs(tables, today)
        chosen = arguments.tables or list(jobs)
        rebuild_all({name: jobs[name] for name in chosen}, arguments.staging, F.current_timestamp())
    elif arguments.job == "metadata":
        stored = read_manifest(spark, arguments.target, METADATA_DB, ["_id", "_rev"])
        write_documents(dim.metadata_documents(tables, stored), arguments.target, METADATA_DB)
    elif arguments.job == "first-load":
        members = cohort(tables["flat_hiv_summary"], today, arguments.location)
        name = location_db(F.lit(arguments.location))
        for table in arguments.tables or SYNCED:
            staged = read_staging(spark, arguments.staging, table)
            docs = initial_load(table, staged, members, arguments.location)
            write_documents(docs.withColumn("db", name), arguments.target)
    elif arguments.job == "nightly":
        summary = tables["flat_hiv_summary"]
        nightly_upsert(spark, arguments.staging, arguments.target, summary, today, arguments.tables or SYNCED)
        nightly_delete(spark, arguments.target, summary, today, day(arguments.date - timedelta(days=1)))
    else:
        topic = arguments.table
        name, schema = TOPICS[topic]
        staging = stream_jobs.Staging(arguments.staging, topic, f"{topic}-stream")
        job = stream_job(topic, tables, staging)
        if arguments.target:
            touched = "patient_id" if "patient_id" in schema.fieldNames() else "person_id"
            summary = tables["flat_hiv_summary"]
            job = stream_jobs.staged_then_sync(job, staging, arguments.target, summary, F.current_date, touched)
        stream = after_image(changes(spark, arguments), schema, name, exact=False)
        interval = None if arguments.once else arguments.interval
        stream_jobs.run_stream(stream, job, arguments.checkpoint, interval).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--source", help="folder of parquet tables")
    common.add_argument("--jdbc", help="database URL")
    common.add_argument("--option", action="append", default=[], help="name=value for the database reader")
    common.add_argument("--highest-key", type=int, default=10_000_000)
    common.add_argument("--ranges", type=int, default=200)
    common.add_argument("--date", type=date.fromisoformat, default=date.today())
    common.add_argument("--tables", nargs="*", help="staging tables, all by default")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, needed in {
        "rebuild": ["staging"],
        "metadata": ["target"],
        "first-load": ["staging", "target"],
        "nightly": ["staging", "target"],
        "stream": ["staging", "checkpoint"],
    }.items():
        job = jobs.add_parser(name, parents=[common])
        for option in needed:
            job.add_argument(f"--{option}", required=True)
        if name == "first-load":
            job.add_argument("--location", type=int, required=True)
        if name == "stream":
            job.add_argument("table", choices=sorted(TOPICS))
            job.add_argument("--target")
            job.add_argument("--inbox")
            job.add_argument("--servers")
            job.add_argument("--topic")
            job.add_argument("--per-trigger", type=int)
            job.add_argument("--interval", default=stream_jobs.INTERVAL)
            job.add_argument("--once", action="store_true", help="take what is there and end")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    arguments = parser().parse_args(argv)
    run(with_recommended(SparkSession.builder.appName(f"chartloom-{arguments.job}")).getOrCreate(), arguments)


if __name__ == "__main__":
    main()
