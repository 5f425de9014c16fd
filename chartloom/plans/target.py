"""Staged rows to documents of the target database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.functions.json import parse_doc_json, to_doc_json
from chartloom.functions.text import display
from chartloom.operators.nesting import DEALT
from chartloom.operators.relational import rename_map, restrict_to
from chartloom.operators.sync import PART_MARK
from chartloom.operators.windows import latest_n
from chartloom.session import written

# Columns kept as JSON text in staging, with their types.
JSON_COLUMNS = {
    "encounter": {
        "visit": schemas.VISIT,
        "orders": schemas.ORDERS,
        "obs": schemas.OBSERVATIONS,
        "encounterproviders": schemas.ENCOUNTER_PROVIDERS,
    },
    "patient": {"patient": schemas.PATIENT},
}

# Names in the document, by staging table.
DOCUMENT_NAMES = {
    "encounter": {
        "encounterdatetime": "encounterDatetime",
        "encountertype": "encounterType",
        "encounterproviders": "encounterProviders",
    },
    "program_enrollment": {"date_enrolled": "dateEnrolled", "date_completed": "dateCompleted"},
    "lab_orders": {
        "conceptuuid": "conceptUuid",
        "ordernumber": "orderNumber",
        "locationuuid": "locationUuid",
    },
}

# Tables of which a target holds the ten latest rows per person, and their time column.
RECENT_ONLY = {
    "encounter": "encounterdatetime",
    "vitals": "encounter_datetime",
    "hiv_summary": "encounter_datetime",
}
RECENT = 10


def as_json_columns(table: str, df: DataFrame) -> DataFrame:
    """Nested columns of a document as JSON text, for a store without nested types."""
    return df.withColumns({c: to_doc_json(c) for c in JSON_COLUMNS.get(table, {}) if c in df.columns})


# Tables whose documents are named by a number of their own source table; several share one database.
ID_PREFIX = {"patient": "patient_", "encounter": "encounter_"}


def document_id(table: str = "") -> Column:
    """Key in the target: that of the document behind the prefix of its table, and the number of a continuation part."""
    part = F.when(F.col("part") > 0, display(F.lit(""), "part", sep=PART_MARK)).otherwise(F.lit(""))
    return F.concat(F.lit(ID_PREFIX.get(table, "")), F.col("doc_id"), part)


def recent(df: DataFrame, time: str, n: int = RECENT) -> DataFrame:
    """The latest documents of every person, with all their parts."""
    if "part" not in df.columns:
        return latest_n(df, "person_id", time, n, tiebreak="encounter_id")
    if "encounter_id" in df.columns and df.schema["encounter_id"].metadata == DEALT:
        # Documents stay where they are: their keys are ranked, if each is that of one document.
        keys = written(df.where("part = 0").select("person_id", "encounter_id", time), "document-keys")
        if keys.groupBy("encounter_id").count().where("encounter_id IS NULL OR count > 1").isEmpty():
            return df.join(latest_n(keys, "person_id", time, n, tiebreak="encounter_id").select("encounter_id"), "encounter_id", "left_semi")
    mains = latest_n(df.where("part = 0"), "person_id", time, n, tiebreak="encounter_id")
    return mains.unionByName(restrict_to(df.where("part > 0"), mains, "doc_id"))


def to_target(table: str, df: DataFrame) -> DataFrame:
    """Target form of a staging table: ``_id``, typed nested columns, document names, recent rows."""
    rows = df
    if table in RECENT_ONLY:
        rows = recent(rows, RECENT_ONLY[table])
    parsed = {
        c: parse_doc_json(c, schema)
        for c, schema in JSON_COLUMNS.get(table, {}).items()
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)
    }
    key = document_id(table) if "part" in df.columns else F.concat(F.lit(ID_PREFIX.get(table, "")), F.col("doc_id").cast("string"))
    rows = rows.withColumns({**parsed, "_id": key}).drop("doc_id", "part")
    if table == "lab_orders":
        rows = rows.drop("str_id", "order_id")
    return rename_map(rows, DOCUMENT_NAMES.get(table, {}))
