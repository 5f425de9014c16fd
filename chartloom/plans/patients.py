"""Patient documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.dates import age_years
from chartloom.functions.text import display, full_name
from chartloom.operators.nesting import PART_ROWS, Nested, nest
from chartloom.operators.relational import ensure_build_date, fill_strings, tag

# Fields of the preferred address -> column of the patient view.
ADDRESS_FIELDS = {
    "cityVillage": "person_address_city_village",
    "longitude": "person_address_longitude",
    "latitude": "person_address_latitude",
    "country": "person_address_country",
    "countyDistrict": "person_address_county_district",
    "address1": "person_address_1",
    "address2": "person_address_2",
    "address3": "person_address_3",
    "address4": "person_address_4",
    "address5": "person_address_5",
    "address6": "person_address_6",
    "preferred": "person_address_preferred",
}

PERSON_COLUMNS = [
    *"person_uuid given_name middle_name family_name gender birthdate dead death_date".split(),
    *"cause_of_death birthdate_estimated".split(),
]


def attribute_element() -> Column:
    return F.struct(
        display("person_attribute_type_name", F.lit("="), "person_attribute_value").alias("display"),
        F.col("person_attribute_value").alias("value"),
        F.col("person_attribute_uuid").alias("uuid"),
        F.col("person_attribute_voided").alias("voided"),
        F.struct(
            F.col("person_attribute_type_name").alias("display"), F.col("person_attribute_type_uuid").alias("uuid")
        ).alias("attributeType"),
    )


def identifier_element() -> Column:
    return F.struct(
        "identifier",
        F.col("identifier_preferred").alias("preferred"),
        F.struct(
            F.col("identifier_location_name").alias("name"), F.col("identifier_location_uuid").alias("uuid")
        ).alias("location"),
        F.struct(F.col("identifier_type_name").alias("name"), F.col("identifier_type_uuid").alias("uuid")).alias(
            "identifierType"
        ),
    )


def _present(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def patient_documents(
    view: DataFrame,
    as_of: Column,
    built_at: Column | None = None,
    keep_empty: bool = False,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One document per person of the flat view, which repeats a person for every pair of
    attribute and identifier.

    ``keep_empty`` keeps the one blank element of persons without attributes or identifiers.
    """
    firsts = {c: c for c in [*PERSON_COLUMNS, *ADDRESS_FIELDS.values()]}
    arrays = [
        Nested("attributes", attribute_element(), when=None if keep_empty else _present("person_attribute_uuid")),
        Nested("identifiers", identifier_element(), when=None if keep_empty else _present("identifier")),
    ]
    rows = nest(fill_strings(view), "person_id", arrays, firsts, list(firsts), part_rows)
    name = full_name("given_name", "middle_name", "family_name").alias("display")
    person = F.struct(
        F.col("person_uuid").alias("uuid"),
        name,
        "gender",
        "birthdate",
        "dead",
        age_years("birthdate", as_of).alias("age"),
        F.col("death_date").alias("deathDate"),
        F.col("cause_of_death").alias("causeOfDeath"),
        F.col("birthdate_estimated").alias("birthdateEstimated"),
        "attributes",
    )
    address = F.struct(*[F.col(column).alias(field) for field, column in ADDRESS_FIELDS.items()])
    docs = rows.select(
        "person_id",
        F.col("person_id").cast("string").alias("doc_id"),
        "part",
        F.struct(
            F.col("person_uuid").alias("uuid"),
            name,
            person.alias("person"),
            "identifiers",
            address.alias("preferredAddress"),
        ).alias("patient"),
    )
    return ensure_build_date(tag(docs, "patient"), built_at)
