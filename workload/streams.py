"""Change streams: envelopes made of the test tables, in a folder the stream reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.plans.summaries import hiv_summary_documents, vitals_documents
from chartloom.session import work_dir
from chartloom.sources.changes import POSITION, SOURCE, decode, read_file_changes, typed_rows
from chartloom.sources.documents import read_documents
from chartloom.sources.staging import read_staging
from chartloom.streaming.changes import after_image, batch_keys as keys_of, last_changes, route
from chartloom.streaming.jobs import (
    Staging,
    direct,
    encounters_of,
    lab_orders_of,
    labs_of,
    patients_of,
    programs_of,
    rebuild,
    run_stream,
    staged_then_sync,
)
from chartloom.streaming.parse import parse_encounters, parse_hiv_summary, parse_vitals
from workload.documents import (
    as_of,
    enrolments,
    flat_encounters,
    flat_lab_orders,
    flat_patients,
    flat_programs,
    lab_tables,
    patient_view,
    summaries,
)
from workload.registry import ORACLE, query
from workload.standin import SQL, built_at, clinical, load
from workload.sync import DUE_TODAY, TODAY, VITALS_DOC, day, summary


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def envelopes(source: Column, after: Column, position: Column) -> Column:
    """The text of a change event; an after-image of NULL is a delete."""
    payload = F.struct(after.alias("after"), F.lit("u").alias("op"), position.alias("ts_ms"))
    return F.to_json(F.struct(F.struct(source.alias("name")).alias("schema"), payload.alias("payload")))


def write_changes(changes: DataFrame, inbox: str) -> None:
    """Envelopes as compressed text: most of their bytes are names of fields. A file is read by one task, so files are many."""
    changes.write.options(compression="gzip", maxRecordsPerFile=100_000).text(inbox)


def vitals_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as changes of vitals, one encounter per patient and day.

    Signups belong to another table, errors are deletes, and values above 100 arrive broken.
    """
    kind = F.col("event_type")
    after = F.struct(
        F.col("user_id").alias("person_id"),
        F.concat(F.lit("v-"), F.col("event_id").cast("string")).alias("uuid"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("encounter_id"),
        millis("ts").alias("encounter_datetime"),
        F.length("event_type").alias("location_id"),
        F.col("value").cast("string").alias("weight"),
        F.lit("tall").alias("height"),
        F.lit("36.5").alias("temp"),
        F.col("props").alias("pulse"),
    )
    source = F.when(kind == "signup", F.lit("clinic.person.Envelope")).otherwise(F.lit("clinic.vitals.Envelope"))
    text = envelopes(source, F.when(kind != "error", after), F.col("event_id"))
    broken = F.lit('{"schema": {"name": "clinic.vitals.Envelope"}, "payl')
    return load(spark, sf, "events").select(
        "ts", F.when(F.col("value") > 100, broken).otherwise(text).alias("value")
    )


CHANGES = """changes AS (
          SELECT *, user_id * 100 + day(ts) AS encounter_id FROM events
          WHERE event_type NOT IN ('error', 'signup') AND value <= 100)"""
LAST = "QUALIFY row_number() OVER (PARTITION BY user_id, encounter_id ORDER BY event_id DESC) = 1"


@query(
    """SELECT event_id AS position, 'clinic.' || CASE event_type WHEN 'signup' THEN 'person' ELSE 'vitals' END || '.Envelope' AS source,
              CASE WHEN event_type <> 'error' THEN user_id END AS person_id, CASE WHEN event_type <> 'error' THEN value END AS weight,
              event_type = 'error' AS removed
       FROM events WHERE value <= 100"""
)
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    events = decode(vitals_changes(spark, sf), schemas.VITALS_CHANGE).where(F.col(POSITION).isNotNull())
    return events.select(
        F.col(POSITION)["ts_ms"].alias("position"),
        F.col(SOURCE).alias("source"),
        F.col("after.person_id").cast("bigint").alias("person_id"),
        F.col("after.weight").cast("double").alias("weight"),
        F.col("after").isNull().alias("removed"),
    )


@query(
    """SELECT event_id AS position, user_id AS person_id FROM events
       WHERE value <= 100 AND event_type NOT IN ('signup', 'error')"""
)
def cdc_route(spark: SparkSession, sf: str) -> DataFrame:
    events = route(decode(vitals_changes(spark, sf), schemas.VITALS_CHANGE), "vitals", exact=False)
    return events.where(F.col("after").isNotNull()).select(
        F.col(POSITION)["ts_ms"].alias("position"), F.col("after.person_id").cast("bigint").alias("person_id")
    )


@query(
    f"""WITH {CHANGES}
        SELECT 'person_id' AS entity, user_id AS id FROM changes UNION
        SELECT 'encounter_id', encounter_id FROM changes UNION
        SELECT 'location_id', length(event_type) FROM changes"""
)
def batch_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = after_image(vitals_changes(spark, sf), schemas.VITALS_CHANGE, "clinic.vitals.Envelope")
    keys = keys_of(rows, ["person_id", "encounter_id", "location_id"], null_as=0)
    frames = [
        df.select(F.lit(entity).alias("entity"), F.col(entity).cast("bigint").alias("id")) for entity, df in keys.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    f"""WITH {CHANGES} SELECT user_id AS person_id, encounter_id, value AS weight, props AS pulse FROM changes {LAST}"""
)
def last_change_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = after_image(vitals_changes(spark, sf), schemas.VITALS_CHANGE, "clinic.vitals.Envelope")
    last = last_changes(parse_vitals(rows), ["person_id", "encounter_id"])
    wide = [F.col(c).cast("bigint").alias(c) for c in ("person_id", "encounter_id")]
    return last.select(*wide, "weight", "pulse")


def vitals_stream(spark: SparkSession, inbox: str) -> DataFrame:
    changes = read_file_changes(spark, inbox)
    return after_image(changes, schemas.VITALS_CHANGE, "clinic.vitals.Envelope")


def vitals_job(staging: Staging):
    return direct(
        staging, ["person_id", "encounter_id"], lambda rows: vitals_documents(parse_vitals(rows), built_at())
    )


STAGED_VITALS = f"""WITH {CHANGES}
        SELECT 'vitals_' || user_id || '_' || encounter_id AS doc_id, value AS weight, CAST(NULL AS DOUBLE) AS height,
               36.5::DOUBLE AS temp, props AS pulse, date_trunc('second', ts) AS encounter_datetime
        FROM changes {LAST}"""


def staged_vitals(spark: SparkSession, staging: Staging) -> DataFrame:
    return read_staging(spark, staging.root, staging.table).select(
        "doc_id",
        "weight",
        "height",
        "temp",
        "pulse",
        F.col("encounter_datetime").cast("timestamp_ntz").alias("encounter_datetime"),
    )


@query(STAGED_VITALS)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that are documents themselves, through a stream into staging."""
    inbox = work_dir(spark, "inbox")
    vitals_changes(spark, sf).select("value").write.text(inbox)
    staging = Staging(work_dir(spark, "staging"), "vitals")
    run_stream(vitals_stream(spark, inbox), vitals_job(staging), work_dir(spark, "checkpoint"), None).awaitTermination()
    return staged_vitals(spark, staging)


@query(STAGED_VITALS)
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two runs from one checkpoint, and a third that finds nothing new."""
    inbox, checkpoint = work_dir(spark, "inbox"), work_dir(spark, "checkpoint")
    staging = Staging(work_dir(spark, "staging"), "vitals")
    changes = vitals_changes(spark, sf)
    half = F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    for part in (changes.where(F.col("ts") < half), changes.where(F.col("ts") >= half), None):
        if part is not None:
            part.select("value").write.mode("append").text(inbox)
        run_stream(vitals_stream(spark, inbox), vitals_job(staging), checkpoint, None).awaitTermination()
    return staged_vitals(spark, staging)


def encounter_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as changes of encounters."""
    encounters = clinical(spark, sf)["encounter"]
    fields = "encounter_id encounter_type patient_id form_id location_id visit_id uuid".split()
    after = F.struct(
        *fields,
        F.coalesce(F.col("voided").cast("int"), F.lit(0)).alias("voided"),
        millis("encounter_datetime").cast("string").alias("encounter_datetime"),
    )
    return encounters.select(
        envelopes(F.lit("clinic.encounter.Envelope"), after, F.col("encounter_id")).alias("value")
    )


@query(f"WITH {SQL} SELECT * FROM encounter_docs")
def stream_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Encounter documents rebuilt for the encounters a stream touches."""
    inbox = work_dir(spark, "inbox")
    write_changes(encounter_changes(spark, sf), inbox)
    staging = Staging(work_dir(spark, "staging"), "encounter")
    stream = after_image(
        read_file_changes(spark, inbox), schemas.ENCOUNTER_CHANGE, "clinic.encounter.Envelope"
    )
    build = encounters_of(clinical(spark, sf), parse_encounters)
    run_stream(stream, rebuild(staging, build), work_dir(spark, "checkpoint"), None).awaitTermination()
    flat = flat_encounters(read_staging(spark, staging.root, "encounter"))
    wide = {c: F.col(c).cast("bigint") for c in ("encounter_id", "person_id")}
    return flat.withColumns(wide)


@query(
    f"""WITH {CHANGES},
          last AS (SELECT * FROM changes {LAST}),
          recent AS (SELECT * FROM last QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, encounter_id DESC) <= 10),
          members AS (SELECT DISTINCT o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY})
        SELECT 'vitals_' || user_id || '_' || encounter_id AS _id, 'location-' || c_nationkey AS db, user_id AS person_id,
               encounter_id, value AS weight
        FROM recent JOIN members ON o_custkey = user_id"""
)
def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Changes into staging, and what they changed into the databases of the locations concerned."""
    inbox, target = work_dir(spark, "inbox"), work_dir(spark, "documents")
    vitals_changes(spark, sf).select("value").write.text(inbox)
    staging = Staging(work_dir(spark, "staging"), "vitals")
    job = staged_then_sync(vitals_job(staging), staging, target, summary(spark, sf), lambda: day(TODAY))
    run_stream(vitals_stream(spark, inbox), job, work_dir(spark, "checkpoint"), None).awaitTermination()
    return read_documents(spark, target, VITALS_DOC).select("_id", "db", "person_id", "encounter_id", "weight")


def rebuilt(spark: SparkSession, table: str, schema, after: Column, source: DataFrame, build) -> DataFrame:
    """Staged documents after a stream of changes that name entities of a table."""
    inbox = work_dir(spark, "inbox")
    write_changes(source.select(envelopes(F.lit(f"clinic.{table}.Envelope"), after, F.lit(1)).alias("value")), inbox)
    staging = Staging(work_dir(spark, "staging"), table)
    stream = after_image(read_file_changes(spark, inbox), schema, f"clinic.{table}.Envelope")
    run_stream(stream, rebuild(staging, build), work_dir(spark, "checkpoint"), None).awaitTermination()
    return read_staging(spark, staging.root, table)


def unbuilt(name: str) -> str:
    """The SQL of a document query without the time of building."""
    return f"SELECT * EXCLUDE (build_date) FROM ({ORACLE[name]})"


@query(unbuilt("labs_doc"))
def stream_labs(spark: SparkSession, sf: str) -> DataFrame:
    labs, encounters = lab_tables(spark, sf)
    after = F.struct("person_id", "encounter_id")
    docs = rebuilt(spark, "labs", schemas.LAB_CHANGE, after, labs, labs_of(labs, encounters, summaries(spark, sf)))
    return docs.drop("build_date")


@query(unbuilt("patient_doc"))
def stream_patients(spark: SparkSession, sf: str) -> DataFrame:
    people = load(spark, sf, "customer").select(F.col("c_custkey").alias("person_id"))
    view = patient_view(spark, sf)
    docs = rebuilt(spark, "patient", schemas.PERSON_CHANGE, F.struct("person_id"), people, patients_of(view, as_of()))
    return flat_patients(docs).drop("build_date")


@query(unbuilt("program_doc"))
def stream_programs(spark: SparkSession, sf: str) -> DataFrame:
    view = enrolments(spark, sf)
    after = F.struct("patient_program_id", F.col("person_id").alias("patient_id"))
    docs = rebuilt(spark, "program_enrollment", schemas.PROGRAM_ENROLLMENT_CHANGE, after, view, programs_of(view))
    return flat_programs(docs).drop("build_date")


@query(unbuilt("lab_order_doc"))
def stream_lab_orders(spark: SparkSession, sf: str) -> DataFrame:
    tables = clinical(spark, sf)
    tables = tables.replaced(orders=tables["lab_orders"])
    after = F.struct("order_id", "patient_id", "encounter_id")
    docs = rebuilt(spark, "lab_orders", schemas.ORDER_CHANGE, after, tables["orders"], lab_orders_of(tables))
    return flat_lab_orders(docs).drop("build_date")


@query(
    """SELECT user_id AS person_id, event_id AS encounter_id, date_trunc('second', ts) AS encounter_datetime,
              concat_ws('_', 'hivsummary', user_id, event_id) AS doc_id, value AS vl_1,
              CASE WHEN event_type = 'view' THEN 'LOPINAVIR,' END AS cur_arv_meds
       FROM events"""
)
def hiv_change_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Change values of HIV summaries as typed rows and documents; times come in seconds or in milliseconds."""
    seconds = F.floor(millis("ts") / 1000)
    time = F.when(F.col("event_id") % 2 == 0, seconds).otherwise(seconds * 1000)
    fields = [
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("encounter_id"),
        time.alias("encounter_datetime"),
        F.col("value").alias("vl_1"),
        F.when(F.col("event_type") == "view", F.lit("9026")).alias("cur_arv_meds"),
    ]
    changes = load(spark, sf, "events").select(F.to_json(F.struct(*fields)).alias("value"))
    docs = hiv_summary_documents(parse_hiv_summary(typed_rows(changes, schemas.HIV_SUMMARY_CHANGE)), built_at())
    return docs.select(
        F.col("person_id").cast("bigint").alias("person_id"),
        F.col("encounter_id").cast("bigint").alias("encounter_id"),
        F.col("encounter_datetime").cast("timestamp_ntz").alias("encounter_datetime"),
        "doc_id",
        "vl_1",
        "cur_arv_meds",
    )


@query(STAGED_VITALS)
def stream_late_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the newer changes first: older ones do not replace what newer ones have staged."""
    inbox, checkpoint = work_dir(spark, "inbox"), work_dir(spark, "checkpoint")
    staging = Staging(work_dir(spark, "staging"), "vitals")
    changes = vitals_changes(spark, sf)
    for part in (changes.where(F.hour("ts") >= 12), changes.where(F.hour("ts") < 12)):
        part.select("value").write.mode("append").text(inbox)
        run_stream(vitals_stream(spark, inbox), vitals_job(staging), checkpoint, None).awaitTermination()
    return staged_vitals(spark, staging)
