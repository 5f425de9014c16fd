"""Dimensions and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.text import display
from chartloom.operators.relational import rename_map
from chartloom.operators.windows import latest_n
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
from chartloom.plans.target import DOCUMENT_NAMES, as_json_columns, to_target
from workload.registry import query
from workload.scans import names_sql
from workload.standin import BUILT, SQL, built_at, clinical, load, uuid


def joined(array: Column | str, line: object) -> Column:
    """Array elements as one text, for comparison."""
    return F.array_join(F.transform(array, line), ";")


def size(array: Column | str) -> Column:
    return F.coalesce(F.size(array), F.lit(0)).cast("bigint")


# -- dimensions -------------------------------------------------------------------------------


@query(
    f"""WITH {SQL} SELECT 'ep-' || l_orderkey || '-' || l_suppkey AS encounter_provider_uuid, l_orderkey AS encounter_id,
           l_suppkey AS provider_id, provider_uuid, provider_identifier, provider_name
        FROM lineitem JOIN provider ON provider_id = l_suppkey"""
)
def dim_provider(spark: SparkSession, sf: str) -> DataFrame:
    return dim.encounter_providers(clinical(spark, sf))


@query(
    f"""WITH {SQL} SELECT visit_id, visit_uuid, date_started, date_stopped, t.uuid AS visit_type_uuid, t.name AS visit_type_name,
           l.uuid AS visit_location_uuid, l.name AS visit_location_name
        FROM visit v JOIN visit_type t USING (visit_type_id) JOIN location l USING (location_id)"""
)
def dim_visit(spark: SparkSession, sf: str) -> DataFrame:
    return dim.visits(clinical(spark, sf))


@query(f"WITH {SQL} SELECT * FROM dictionary")
def dim_concept(spark: SparkSession, sf: str) -> DataFrame:
    return dim.concepts(clinical(spark, sf))


@query(f"WITH {SQL} SELECT patient_id, uuid AS person_uuid FROM patient JOIN person ON person_id = patient_id")
def dim_patient(spark: SparkSession, sf: str) -> DataFrame:
    return dim.patients(clinical(spark, sf))


@query(
    f"""WITH {SQL} SELECT order_uuid, encounter_id, orderer, 'NEW' AS order_action, date_activated,
           date_activated AS date_created, 'ROUTINE' AS urgency, order_number, order_type_name, concept_uuid, concept_name,
           provider_uuid, provider_identifier, provider_name
        FROM live_orders"""
)
def dim_orders(spark: SparkSession, sf: str) -> DataFrame:
    return dim.orders(clinical(spark, sf))


def metadata_manifest(tables: dim.Tables) -> DataFrame:
    return tables["location"].where("name < 'NATION_3'").select(
        F.col("uuid").alias("_id"), display(F.lit("1"), "location_id", sep="-").alias("_rev")
    )


@query(
    f"""WITH {SQL}, docs AS (
          SELECT uuid AS _id, name, uuid, 'location' AS type, CAST(NULL AS VARCHAR) AS concept_uuid FROM location
          UNION ALL
          SELECT p.uuid, p.name, p.uuid, 'program', c.uuid FROM program p JOIN concept c USING (concept_id))
        SELECT d.*, CASE WHEN type = 'location' AND name < 'NATION_3' THEN '1-' || substr(uuid, 7) END AS _rev,
               TIMESTAMP '{BUILT}' AS build_date
        FROM docs d"""
)
def metadata_docs(spark: SparkSession, sf: str) -> DataFrame:
    tables = clinical(spark, sf)
    docs = dim.metadata_documents(tables, metadata_manifest(tables), built_at())
    return docs.withColumn("concept_uuid", F.col("concept.uuid")).drop("concept")


# -- observation groups and encounters --------------------------------------------------------


def build_obs(tables: dim.Tables, by: str | None = None) -> DataFrame:
    return obs_documents(tables["obs"], dim.concepts(tables), dim.drugs(tables), by=by)


@query(
    f"""WITH {SQL} SELECT obs_id, uuid, encounter_id, obs_datetime, concept_name, value_type, value_not_coded, answer_name,
           members, n_members, 0 AS part
        FROM root_obs"""
)
def obs_doc(spark: SparkSession, sf: str) -> DataFrame:
    member = joined(
        "groupmembers",
        lambda m: F.concat_ws(
            "|", m["uuid"], m["display"], F.coalesce(m["value"]["type"], F.lit("-")), m["value"]["value"]
        ),
    )
    return build_obs(clinical(spark, sf)).select(
        "obs_id",
        "uuid",
        "encounter_id",
        "obs_datetime",
        F.col("parent_obs_concept_name").alias("concept_name"),
        "value_type",
        "value_not_coded",
        F.col("value_coded_concept_name").alias("answer_name"),
        member.alias("members"),
        size("groupmembers").alias("n_members"),
        "part",
    )


def flat_encounters(docs: DataFrame) -> DataFrame:
    """Encounter documents as the oracle sees them."""
    provider = joined("encounterproviders", lambda p: F.concat_ws("|", p["uuid"], p["display"], p["provider"]["display"]))
    order = joined(
        "orders",
        lambda o: F.concat_ws(
            "|", o["uuid"], o["orderNumber"].cast("string"), o["concept"]["display"], o["orderer"]["display"], o["type"]
        ),
    )
    observation = joined(
        "obs",
        lambda b: F.concat_ws(
            "|",
            b["uuid"],
            b["concept"]["name"]["display"],
            F.coalesce(F.concat(b["value"]["type"], F.lit("="), b["value"]["value"]), F.lit("-")),
            F.coalesce(F.json_array_length(b["groupMembers"]), F.lit(0)).cast("string"),
        ),
    )
    return docs.select(
        F.col("doc_id"),
        "encounter_id",
        "person_id",
        "location_id",
        "person_uuid",
        "uuid",
        F.col("encounterdatetime").cast("timestamp_ntz").alias("encounter_datetime"),
        F.col("encountertype.display").alias("type_name"),
        F.col("form.uuid").alias("form_uuid"),
        F.col("location.display").alias("location_name"),
        F.col("visit.uuid").alias("visit_uuid"),
        F.col("visit.display").alias("visit_display"),
        provider.alias("providers"),
        size("encounterproviders").alias("n_providers"),
        order.alias("orders"),
        size("orders").alias("n_orders"),
        observation.alias("observations"),
        size("obs").alias("n_obs"),
    )


@query(f"WITH {SQL} SELECT * FROM encounter_docs")
def encounter_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Encounters in parts of two elements of each array, put together again by part."""
    tables = clinical(spark, sf)
    parts = encounter_documents(tables, build_obs(tables, "encounter_id"), built_at(), part_rows=2)
    arrays = ["encounterproviders", "orders", "obs"]
    others = [F.min_by(c, "part").alias(c) for c in parts.columns if c not in (*arrays, "encounter_id", "part")]
    whole = [F.flatten(F.sort_array(F.collect_list(F.struct("part", a))).getField(a)).alias(a) for a in arrays]
    return flat_encounters(parts.groupBy("encounter_id").agg(*others, *whole))


@query(f"WITH {SQL} SELECT * FROM encounter_docs")
def encounter_doc(spark: SparkSession, sf: str) -> DataFrame:
    tables = clinical(spark, sf)
    return flat_encounters(encounter_documents(tables, build_obs(tables, "encounter_id"), built_at()))


@query(
    f"""WITH {SQL} SELECT * EXCLUDE (doc_id), 'encounter_' || doc_id AS _id FROM encounter_docs
        QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY encounter_datetime DESC, encounter_id DESC) <= 10"""
)
def doc_for_target(spark: SparkSession, sf: str) -> DataFrame:
    """The ten latest encounters of every person with all their content, from the JSON text of the staging form."""
    tables = clinical(spark, sf)
    staged = as_json_columns("encounter", encounter_documents(tables, build_obs(tables, "encounter_id"), built_at()))
    docs = to_target("encounter", staged).withColumnRenamed("_id", "doc_id")
    return flat_encounters(rename_map(docs, {new: old for old, new in DOCUMENT_NAMES["encounter"].items()})).withColumnRenamed("doc_id", "_id")


# -- patients ---------------------------------------------------------------------------------


def as_of() -> Column:
    return F.to_date(F.lit("2021-05-05"))


def patient_view(spark: SparkSession, sf: str) -> DataFrame:
    """Customers times their orders as attributes times two identifiers each, as a flat view has them."""
    customer = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = load(spark, sf, "orders").where("o_orderstatus <> 'P'")
    identifier = F.when(
        F.col("c_acctbal") > 0, F.array(uuid("mrn", "c_custkey"), uuid("nat", "c_nationkey"))
    ).otherwise(F.array(F.lit(None).cast("string")))
    rows = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    no_text = F.lit(None).cast("string")
    return rows.select(
        F.col("c_custkey").alias("person_id"),
        uuid("person", "c_custkey").alias("person_uuid"),
        F.col("c_mktsegment").alias("given_name"),
        no_text.alias("middle_name"),
        F.col("c_name").alias("family_name"),
        F.when(F.col("c_acctbal") > 5000, F.lit("F")).alias("gender"),
        F.to_timestamp_ntz(F.lit("1980-06-01 00:00:00")).alias("birthdate"),
        F.lit(False).alias("dead"),
        F.lit(None).cast("timestamp_ntz").alias("death_date"),
        no_text.alias("cause_of_death"),
        F.lit(None).cast("boolean").alias("birthdate_estimated"),
        F.when(F.col("o_orderkey").isNotNull(), uuid("attr", "o_orderkey")).alias("person_attribute_uuid"),
        F.col("o_orderpriority").alias("person_attribute_type_name"),
        F.col("o_orderstatus").alias("person_attribute_value"),
        F.lit(False).alias("person_attribute_voided"),
        uuid("type", "o_orderpriority").alias("person_attribute_type_uuid"),
        F.explode(identifier).alias("identifier"),
        F.lit(True).alias("identifier_preferred"),
        F.col("n_name").alias("identifier_location_name"),
        uuid("place", "n_nationkey").alias("identifier_location_uuid"),
        F.lit("number").alias("identifier_type_name"),
        F.lit("type-1").alias("identifier_type_uuid"),
        F.col("n_name").alias("person_address_country"),
        *[
            no_text.alias(f"person_address_{c}")
            for c in "city_village longitude latitude county_district 1 2 3 4 5 6 preferred".split()
        ],
    )


@query(
    f"""WITH a AS (
          SELECT o_custkey, count(*) AS n, string_agg('attr-' || o_orderkey || '|' || o_orderpriority || ' = ' || o_orderstatus, ';'
                 ORDER BY o_orderpriority || ' = ' || o_orderstatus, o_orderstatus, 'attr-' || o_orderkey) AS attributes
          FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
        SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment || '  ' || c_name AS display, 41 AS age,
               CASE WHEN c_acctbal > 5000 THEN 'F' ELSE '' END AS gender, n_name AS country,
               coalesce(a.attributes, '') AS attributes, coalesce(a.n, 0) AS n_attributes,
               CASE WHEN c_acctbal > 0 THEN 'mrn-' || c_custkey || '@' || n_name || ';nat-' || c_nationkey || '@' || n_name ELSE '' END AS identifiers,
               'patient' AS type, TIMESTAMP '{BUILT}' AS build_date, 0 AS part
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN a ON o_custkey = c_custkey"""
)
def patient_doc(spark: SparkSession, sf: str) -> DataFrame:
    return flat_patients(patient_documents(patient_view(spark, sf), as_of(), built_at()))


def flat_patients(docs: DataFrame) -> DataFrame:
    attribute = joined("patient.person.attributes", lambda a: F.concat_ws("|", a["uuid"], a["display"]))
    identifier = joined("patient.identifiers", lambda i: F.concat_ws("@", i["identifier"], i["location"]["name"]))
    return docs.select(
        "doc_id",
        F.col("patient.display").alias("display"),
        F.col("patient.person.age").alias("age"),
        F.col("patient.person.gender").alias("gender"),
        F.col("patient.preferredAddress.country").alias("country"),
        attribute.alias("attributes"),
        size("patient.person.attributes").alias("n_attributes"),
        identifier.alias("identifiers"),
        "type",
        "build_date",
        "part",
    )


# -- documents of one row ---------------------------------------------------------------------

CODES = """CASE event_type WHEN 'click' THEN '625 ## 628' WHEN 'view' THEN '6964 ## 17' WHEN 'purchase' THEN '17' END"""
LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10"


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.expr(CODES)
    return load(spark, sf, "events").select(
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("encounter_id"),
        F.col("ts").alias("encounter_datetime"),
        F.when(F.col("event_type").isin("click", "view", "purchase"), F.lit(1))
        .otherwise(F.lit(0))
        .alias("is_clinical_encounter"),
        codes.alias("cur_arv_meds"),
        codes.alias("arv_first_regimen"),
        F.lit(None).cast("string").alias("cur_arv_meds_strict"),
        F.lit("9026").alias("prev_arv_meds"),
    )


def vitals(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("encounter_id"),
        F.col("ts").alias("encounter_datetime"),
        F.col("value").alias("weight"),
    )


@query(
    f"""SELECT user_id AS person_id, event_id AS encounter_id, ts AS encounter_datetime, value AS weight,
               concat_ws('_', 'vitals', user_id, event_id) AS doc_id, 'vitals' AS type, TIMESTAMP '{BUILT}' AS build_date
        FROM events {LATEST}"""
)
def vitals_doc(spark: SparkSession, sf: str) -> DataFrame:
    recent = latest_n(vitals(spark, sf), "person_id", "encounter_datetime", 10, tiebreak="encounter_id")
    return vitals_documents(recent, built_at())


@query(
    f"""SELECT user_id AS person_id, event_id AS encounter_id, ts AS encounter_datetime,
               CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1 ELSE 0 END AS is_clinical_encounter,
               {names_sql(CODES)} AS cur_arv_meds, {names_sql(CODES)} AS arv_first_regimen,
               CAST(NULL AS VARCHAR) AS cur_arv_meds_strict, 'LOPINAVIR,' AS prev_arv_meds,
               concat_ws('_', 'hivsummary', user_id, event_id) AS doc_id, 'hiv_summary' AS type, TIMESTAMP '{BUILT}' AS build_date
        FROM events {LATEST}"""
)
def hiv_summary_doc(spark: SparkSession, sf: str) -> DataFrame:
    recent = latest_n(summaries(spark, sf), "person_id", "encounter_datetime", 10, tiebreak="encounter_id")
    return hiv_summary_documents(recent, built_at())


@query(
    f"""WITH clinical AS (SELECT *, {CODES} AS codes FROM events WHERE event_type IN ('click', 'view', 'purchase')),
          regimen AS (
            SELECT user_id, CAST(ts AS DATE) AS encounter_date, min(ts) AS encounter_datetime, arg_min(codes, (ts, event_id)) AS codes
            FROM clinical GROUP BY 1, 2)
        SELECT e.user_id AS person_id, event_id AS encounter_id, ts AS test_datetime, 'lab-' || event_id AS person_uuid,
               CAST(c_nationkey AS INTEGER) AS location_id, encounter_date, encounter_datetime, {names_sql("r.codes")} AS cur_arv_meds,
               concat_ws('_', 'labs', e.user_id, event_id) AS doc_id, 'labs' AS type, TIMESTAMP '{BUILT}' AS build_date
        FROM events e LEFT JOIN customer ON c_custkey = e.user_id
        LEFT JOIN regimen r ON r.user_id = e.user_id AND r.encounter_datetime = e.ts"""
)
def labs_doc(spark: SparkSession, sf: str) -> DataFrame:
    return labs_documents(*lab_tables(spark, sf), summaries(spark, sf), built_at=built_at())


def lab_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Labs, and the places of their encounters."""
    events = load(spark, sf, "events")
    labs = events.select(
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("encounter_id"),
        F.col("ts").alias("test_datetime"),
        uuid("lab", "event_id").alias("uuid"),
    )
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    encounters = events.join(customer, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").alias("encounter_id"), F.col("c_nationkey").alias("location_id")
    )
    return labs, encounters


def enrolments(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (load(spark, sf, t) for t in ("customer", "nation", "region"))
    placed = (
        load(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("patient_program_id"),
        uuid("enrolment", "o_orderkey").alias("uuid"),
        F.col("n_name").alias("location_name"),
        uuid("place", "n_nationkey").alias("location_uuid"),
        F.col("r_name").alias("program_name"),
        uuid("program", "r_regionkey").alias("program_uuid"),
        F.col("o_orderdate").alias("date_enrolled"),
    )


@query(
    f"""SELECT o_custkey AS person_id, o_orderkey AS patient_program_id, 'enrolment-' || o_orderkey AS uuid,
               'enrolment-' || o_orderkey AS doc_id, n_name AS location_name, 'place-' || n_nationkey AS location_uuid,
               r_name AS program_name, 'program-' || r_regionkey AS program_uuid, o_orderdate AS date_enrolled,
               'program_enrollment' AS type, TIMESTAMP '{BUILT}' AS build_date
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""
)
def program_doc(spark: SparkSession, sf: str) -> DataFrame:
    return flat_programs(program_documents(enrolments(spark, sf), built_at()))


def flat_programs(docs: DataFrame) -> DataFrame:
    return docs.select(
        "person_id",
        "patient_program_id",
        "uuid",
        "doc_id",
        F.col("location.name").alias("location_name"),
        F.col("location.uuid").alias("location_uuid"),
        F.col("program.name").alias("program_name"),
        F.col("program.uuid").alias("program_uuid"),
        "date_enrolled",
        "type",
        "build_date",
    )


@query(
    f"""WITH {SQL}, names AS (SELECT person_id, person_name FROM person_name),
          samples AS (
            SELECT order_id, arg_min(uuid, (obs_datetime, uuid)) AS obs_uuid, min(obs_datetime) AS sample_collection_date,
                   arg_min(struct_pack(c := value_coded), (obs_datetime, uuid, coalesce(value_coded, -1))).c AS value_coded
            FROM obs WHERE order_id IS NOT NULL AND (voided IS NULL OR NOT voided) GROUP BY 1)
        SELECT o_orderkey AS order_id, 'order-' || o_orderkey AS uuid, o_orderpriority AS ordernumber, o_orderdate AS date_activated,
               o_custkey AS patient_id, o_orderkey AS encounter_id, o_custkey AS order_type, d.concept_uuid AS conceptuuid,
               d.concept_name AS display, p.provider_uuid, p.provider_name, s.obs_uuid, s.sample_collection_date,
               k.concept_name AS sample_drawn, c_nationkey AS location_id, 'place-' || c_nationkey AS locationuuid, l.name AS location_name,
               o_custkey AS person_id, 'person-' || o_custkey AS person_uuid, 'person-' || o_custkey AS patient_uuid, n.person_name,
               'mrn-' || o_custkey || ';nat-' || c_nationkey AS identifiers, 0 AS part,
               concat_ws('_', 'lab_orders', o_custkey, o_orderkey, 'order-' || o_orderkey) AS doc_id, 'lab_orders' AS type,
               TIMESTAMP '{BUILT}' AS build_date
        FROM placed LEFT JOIN dictionary d ON d.concept_id = o_custkey LEFT JOIN provider p ON p.provider_id = o_custkey
        LEFT JOIN samples s ON s.order_id = o_orderkey LEFT JOIN dictionary k ON k.concept_id = s.value_coded
        LEFT JOIN location l ON l.location_id = c_nationkey LEFT JOIN names n ON n.person_id = o_custkey
        WHERE o_orderstatus <> 'F'"""
)
def lab_order_doc(spark: SparkSession, sf: str) -> DataFrame:
    tables = clinical(spark, sf)
    return flat_lab_orders(lab_order_documents(tables.replaced(orders=tables["lab_orders"]), built_at()))


def flat_lab_orders(docs: DataFrame) -> DataFrame:
    return docs.withColumn("identifiers", F.array_join("identifiers", ";"))
