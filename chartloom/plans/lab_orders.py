"""Lab order documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import doc_key
from chartloom.operators.nesting import PART_ROWS, nest_set
from chartloom.operators.relational import ensure_build_date, lookup, measured, not_voided, rename_map, tag
from chartloom.plans import dimensions as dim
from chartloom.session import concurrently


def lab_order_documents(
    tables: dim.Tables, built_at: Column | None = None, part_rows: int = PART_ROWS
) -> DataFrame:
    """One document per live order; everything but the order itself may be missing.

    Names, identifiers and samples are one row per person or order before they are joined, so an
    order is never multiplied and needs no grouping afterwards.
    """
    orders = not_voided(tables["orders"]).select(
        *"order_id order_type_id uuid date_activated patient_id encounter_id orderer concept_id".split(),
        F.col("order_number").alias("ordernumber"),
    )
    codes, people = concurrently(lambda: measured(dim.concepts(tables)), lambda: dim.providers_by_id(tables))
    places = dim.locations(tables).withColumnRenamed("location_uuid", "locationuuid")
    identifiers = nest_set(
        dim.identifiers(tables), "patient_id", F.col("identifier"), "identifiers", part_rows=part_rows
    )
    persons = dim.persons(tables).withColumn("patient_id", F.col("person_id"))
    names = dim.person_names(tables).withColumnRenamed("person_id", "patient_id")

    rows = lookup(orders, codes, "concept_id", "left")
    rows = rename_map(rows, {"concept_uuid": "conceptuuid", "concept_name": "display", "concept_id": "order_type"})
    rows = lookup(rows, people, [("orderer", "provider_id")], "left", spread_nulls=True).drop("provider_identifier")
    rows = lookup(rows, dim.order_samples(tables, codes), "order_id", "left")
    placed = tables["encounter"].select("encounter_id", "location_id")
    rows = lookup(rows, placed, "encounter_id", "left", spread_nulls=True)
    rows = lookup(rows, places, "location_id", "left")
    # One join by patient, so that a patient with very many orders is skewed in one place only and
    # can be split there.
    known = persons.join(names, "patient_id", "full").join(identifiers, "patient_id", "full")
    rows = rows.join(known, "patient_id", "left")
    docs = rows.withColumns(
        {
            "identifiers": F.coalesce("identifiers", F.array().cast("array<string>")),
            "part": F.coalesce("part", F.lit(0)),
            "patient_uuid": F.col("person_uuid"),
            "doc_id": doc_key("lab_orders", "patient_id", "encounter_id", "uuid"),
        }
    )
    # The order key stays in staging, where it finds the documents a change touches.
    return ensure_build_date(tag(docs.drop("orderer", "order_type_id"), "lab_orders"), built_at)
