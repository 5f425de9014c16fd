"""Documents that follow one source row: HIV summaries, vitals, labs, programme enrolments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.drugs import drug_names
from chartloom.functions.text import doc_key
from chartloom.operators.nesting import one_per_day
from chartloom.operators.relational import ensure_build_date, replace_columns, tag

# HIV summary columns that hold drug code lists.
REGIMEN_COLUMNS = ["cur_arv_meds", "arv_first_regimen", "cur_arv_meds_strict", "prev_arv_meds"]


def hiv_summary_documents(summary: DataFrame, built_at: Column | None = None) -> DataFrame:
    decoded = replace_columns(summary, {c: drug_names(c) for c in REGIMEN_COLUMNS})
    docs = decoded.withColumn("doc_id", doc_key("hivsummary", "person_id", "encounter_id"))
    return ensure_build_date(tag(docs, "hiv_summary"), built_at)


def vitals_documents(vitals: DataFrame, built_at: Column | None = None) -> DataFrame:
    docs = vitals.withColumn("doc_id", doc_key("vitals", "person_id", "encounter_id"))
    return ensure_build_date(tag(docs, "vitals"), built_at)


def program_documents(enrolments: DataFrame, built_at: Column | None = None) -> DataFrame:
    docs = enrolments.withColumns(
        {
            "doc_id": F.col("uuid"),
            "location": F.struct(F.col("location_name").alias("name"), F.col("location_uuid").alias("uuid")),
            "program": F.struct(F.col("program_name").alias("name"), F.col("program_uuid").alias("uuid")),
        }
    ).drop("program_name", "location_uuid", "location_name")
    return ensure_build_date(tag(docs, "program_enrollment"), built_at)


def regimens_in_force(summary: DataFrame, by: Sequence[str] = ("person_id",)) -> DataFrame:
    """The regimen of the first clinical encounter of every day."""
    clinical = summary.where("is_clinical_encounter = 1")
    return one_per_day(
        clinical,
        "encounter_datetime",
        ["cur_arv_meds"],
        by=by,
        tiebreak=["encounter_id"],
        day_name="encounter_date",
    )


def labs_documents(
    labs: DataFrame,
    encounters: DataFrame,
    summary: DataFrame,
    by: Sequence[str] = ("person_id",),
    built_at: Column | None = None,
) -> DataFrame:
    """Lab rows with the place of their encounter and the regimen in force at the test.

    The regimen belongs to the same person; ``by=()`` takes the one of any person at that moment.
    """
    regimens = regimens_in_force(summary, by)
    keyed = regimens.select(*[F.col(c).alias(f"__by_{c}") for c in by], *[c for c in regimens.columns if c not in by])
    match = [F.col("encounter_datetime") == F.col("test_datetime"), *[F.col(c) == F.col(f"__by_{c}") for c in by]]
    placed = labs.join(encounters.select("encounter_id", "location_id"), "encounter_id", "left")
    rows = placed.join(keyed, match, "left").drop(*[f"__by_{c}" for c in by])
    docs = replace_columns(
        rows.withColumnRenamed("uuid", "person_uuid"),
        {"cur_arv_meds": drug_names("cur_arv_meds"), "doc_id": doc_key("labs", "person_id", "encounter_id")},
    )
    return ensure_build_date(tag(docs, "labs"), built_at)
