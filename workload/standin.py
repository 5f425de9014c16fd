"""The test tables in the roles of clinical source tables.

Customers are patients, nations are locations, suppliers are providers, parts are concepts, orders
are encounters, line items are what was ordered and observed, conversations are observation
groups, events are vitals, summaries and labs. ``SQL`` states the same mapping for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.sources.tables import ParquetTables, read_table

BUILT = "2020-01-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, ParquetTables(sf_dir), name)


def built_at() -> Column:
    return F.to_timestamp_ntz(F.lit(BUILT))


def uuid(kind: str, *columns: str) -> Column:
    return F.concat_ws("-", F.lit(kind), *[F.col(c).cast("string") for c in columns])


class LazyTables(Mapping):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self.makers = {name: cache(make) for name, make in makers.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self.makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)

    def replaced(self, **others: DataFrame) -> LazyTables:
        return LazyTables({**self.makers, **{name: lambda df=df: df for name, df in others.items()}})


def clinical(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Source tables by name."""

    @cache
    def t(name: str) -> DataFrame:
        return load(spark, sf_dir, name)

    priority = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    customer, supplier, lineitem, orders = t("customer"), t("supplier"), t("lineitem"), t("orders")
    placed = orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))

    def dictionary(name: str) -> DataFrame:
        return t("region").select(
            F.col("r_regionkey").alias(f"{name}_id"), uuid(name, "r_regionkey").alias("uuid"), F.col("r_name").alias("name")
        )

    people = customer.select(
        F.col("c_custkey").alias("person_id"),
        F.col("c_mktsegment").alias("given_name"),
        F.lit(None).cast("string").alias("middle_name"),
        F.col("c_name").alias("family_name"),
        uuid("name", "c_custkey").alias("uuid"),
        (F.col("c_acctbal") > 0).alias("preferred"),
    ).unionByName(
        supplier.select(
            (-F.col("s_suppkey") - 1).alias("person_id"),
            F.lit("Dr").alias("given_name"),
            F.when(F.col("s_nationkey") > 12, F.lit("M")).alias("middle_name"),
            F.col("s_name").alias("family_name"),
            uuid("sname", "s_suppkey").alias("uuid"),
            (F.col("s_acctbal") > 1000).alias("preferred"),
        )
    )
    line = uuid("line", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    measured = lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 1_000_000_000).alias("obs_id"),
        F.col("l_partkey").alias("concept_id"),
        F.col("l_orderkey").alias("encounter_id"),
        F.col("l_orderkey").alias("order_id"),
        F.lit(None).cast("bigint").alias("obs_group_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).alias("value_coded"),
        F.when(F.col("l_returnflag") == "A", F.col("l_suppkey")).alias("value_drug"),
        F.lit(None).cast("string").alias("value_text"),
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).alias("value_numeric"),
        F.lit(None).cast("timestamp_ntz").alias("value_datetime"),
        F.col("l_shipdate").alias("obs_datetime"),
        line.alias("uuid"),
        (F.col("l_tax") > 0.07).alias("voided"),
    )
    turn_id = F.col("conv_id") * 100 + F.col("turn")
    spoken = t("conversations").select(
        turn_id.alias("obs_id"),
        (F.col("conv_id") + F.col("turn")).alias("concept_id"),
        F.col("conv_id").alias("encounter_id"),
        F.lit(None).cast("bigint").alias("order_id"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 100).alias("obs_group_id"),
        F.when(F.col("role") == "system", F.col("conv_id")).alias("value_coded"),
        F.when((F.col("role") == "assistant") & (F.col("turn") > 3), F.col("turn")).alias("value_drug"),
        F.when(F.col("role") == "user", F.col("text")).alias("value_text"),
        F.when((F.col("role") == "assistant") & (F.col("turn") < 3), F.length("text").cast("double")).alias(
            "value_numeric"
        ),
        F.when(F.col("turn") == 3, F.to_timestamp_ntz(F.lit("2024-05-06 07:08:09"))).alias("value_datetime"),
        F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("obs_datetime"),
        uuid("turn", "conv_id", "turn").alias("uuid"),
        F.when(F.col("turn") < 7, F.lit(False)).alias("voided"),
    )
    return LazyTables({
        **{name: partial(dictionary, name) for name in ("form", "encounter_type", "visit_type", "order_type")},
        "location": lambda: t("nation").select(
            F.col("n_nationkey").alias("location_id"),
            uuid("place", "n_nationkey").alias("uuid"),
            F.col("n_name").alias("name"),
        ),
        "program": lambda: t("region").select(
            F.col("r_name").alias("name"), uuid("program", "r_regionkey").alias("uuid"), F.col("r_regionkey").alias("concept_id")
        ),
        "concept": lambda: t("part").select(
            F.col("p_partkey").alias("concept_id"),
            uuid("concept", "p_partkey").alias("uuid"),
            (F.col("p_size") > 40).alias("retired"),
        ),
        "concept_name": lambda: t("part").select(
            F.col("p_partkey").alias("concept_id"),
            F.col("p_name").alias("name"),
            (F.col("p_brand") != "Brand#3").alias("locale_preferred"),
        ),
        "drug": lambda: supplier.select(F.col("s_suppkey").alias("drug_id"), F.col("s_name").alias("name")),
        "person": lambda: customer.select(F.col("c_custkey").alias("person_id"), uuid("person", "c_custkey").alias("uuid")),
        "patient": lambda: customer.where("c_acctbal > -500").select(F.col("c_custkey").alias("patient_id")),
        "person_name": lambda: people,
        "provider": lambda: supplier.select(
            F.col("s_suppkey").alias("provider_id"),
            (-F.col("s_suppkey") - 1).alias("person_id"),
            uuid("provider", "s_suppkey").alias("uuid"),
            uuid("P", "s_nationkey").alias("identifier"),
        ),
        "patient_identifier": lambda: customer.select(
            F.col("c_custkey").alias("patient_id"),
            F.explode(F.array(uuid("mrn", "c_custkey"), uuid("nat", "c_nationkey"))).alias("identifier"),
        ),
        "encounter": lambda: placed.select(
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").alias("patient_id"),
            priority.alias("form_id"),
            F.col("c_nationkey").alias("location_id"),
            F.col("o_orderkey").alias("visit_id"),
            priority.alias("encounter_type"),
            F.col("o_orderdate").alias("encounter_datetime"),
            uuid("enc", "o_orderkey").alias("uuid"),
            F.when(F.col("o_totalprice") < 450000, F.col("o_totalprice") < 20000).alias("voided"),
        ),
        "visit": lambda: placed.where("NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')").select(
            F.col("o_orderkey").alias("visit_id"),
            priority.alias("visit_type_id"),
            F.col("c_nationkey").alias("location_id"),
            uuid("visit", "o_orderkey").alias("uuid"),
            F.col("o_orderdate").alias("date_started"),
            F.lit(None).cast("timestamp_ntz").alias("date_stopped"),
        ),
        "encounter_provider": lambda: lineitem.select(
            F.col("l_orderkey").alias("encounter_id"),
            F.col("l_suppkey").alias("provider_id"),
            uuid("ep", "l_orderkey", "l_suppkey").alias("uuid"),
        ),
        "orders": lambda: lineitem.select(
            line.alias("uuid"),
            F.col("l_orderkey").alias("encounter_id"),
            F.col("l_partkey").alias("concept_id"),
            F.col("l_suppkey").alias("orderer"),
            F.lit("NEW").alias("order_action"),
            F.col("l_shipdate").alias("date_activated"),
            F.col("l_shipdate").alias("date_created"),
            F.lit("ROUTINE").alias("urgency"),
            F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(F.lit(1)).alias("order_type_id"),
            F.col("l_linenumber").cast("string").alias("order_number"),
            (F.col("l_returnflag") == "A").alias("voided"),
        ),
        "lab_orders": lambda: placed.select(
            F.col("o_orderkey").alias("order_id"),
            uuid("order", "o_orderkey").alias("uuid"),
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").alias("patient_id"),
            F.col("o_custkey").alias("concept_id"),
            F.col("o_custkey").alias("orderer"),
            F.lit(1).alias("order_type_id"),
            F.col("o_orderdate").alias("date_activated"),
            F.col("o_orderpriority").alias("order_number"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("voided"),
        ),
        "obs": lambda: measured.unionByName(spoken),
    })


# The same mapping, as common table expressions that follow WITH.
SQL = """
form AS (SELECT r_regionkey AS form_id, 'form-' || r_regionkey AS uuid, r_name AS name FROM region),
encounter_type AS (SELECT r_regionkey AS encounter_type_id, 'encounter_type-' || r_regionkey AS uuid, r_name AS name FROM region),
visit_type AS (SELECT r_regionkey AS visit_type_id, 'visit_type-' || r_regionkey AS uuid, r_name AS name FROM region),
order_type AS (SELECT r_regionkey AS order_type_id, 'order_type-' || r_regionkey AS uuid, r_name AS name FROM region),
location AS (SELECT n_nationkey AS location_id, 'place-' || n_nationkey AS uuid, n_name AS name FROM nation),
program AS (SELECT r_name AS name, 'program-' || r_regionkey AS uuid, r_regionkey AS concept_id FROM region),
concept AS (SELECT p_partkey AS concept_id, 'concept-' || p_partkey AS uuid, p_size > 40 AS retired FROM part),
concept_name AS (SELECT p_partkey AS concept_id, p_name AS name, p_brand <> 'Brand#3' AS locale_preferred FROM part),
drug AS (SELECT s_suppkey AS drug_id, s_name AS drug_name FROM supplier),
person AS (SELECT c_custkey AS person_id, 'person-' || c_custkey AS uuid FROM customer),
patient AS (SELECT c_custkey AS patient_id FROM customer WHERE c_acctbal > -500),
person_name AS (
  SELECT c_custkey AS person_id, concat_ws(' ', c_mktsegment, c_name) AS person_name, c_acctbal > 0 AS preferred FROM customer
  UNION ALL
  SELECT -s_suppkey - 1, concat_ws(' ', 'Dr', CASE WHEN s_nationkey > 12 THEN 'M' END, s_name), s_acctbal > 1000 FROM supplier),
provider AS (
  SELECT s_suppkey AS provider_id, 'provider-' || s_suppkey AS provider_uuid, 'P-' || s_nationkey AS provider_identifier,
         coalesce(n.person_name, '') AS provider_name
  FROM supplier LEFT JOIN person_name n ON n.person_id = -s_suppkey - 1 AND n.preferred),
placed AS (
  SELECT o.*, c_nationkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS priority
  FROM orders o JOIN customer ON o_custkey = c_custkey),
encounter AS (
  SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, priority, c_nationkey AS location_id,
         o_orderdate AS encounter_datetime, 'enc-' || o_orderkey AS uuid,
         CASE WHEN o_totalprice < 450000 THEN o_totalprice < 20000 END AS voided
  FROM placed),
visit AS (
  SELECT o_orderkey AS visit_id, priority AS visit_type_id, c_nationkey AS location_id, 'visit-' || o_orderkey AS visit_uuid,
         o_orderdate AS date_started, CAST(NULL AS TIMESTAMP) AS date_stopped
  FROM placed WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')),
dictionary AS (
  SELECT c.concept_id, c.uuid AS concept_uuid, n.name AS concept_name
  FROM concept c JOIN concept_name n USING (concept_id) WHERE NOT retired AND locale_preferred),
line_orders AS (
  SELECT concat_ws('-', 'line', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_uuid, l_orderkey AS encounter_id,
         l_partkey AS concept_id, l_suppkey AS orderer, l_shipdate AS date_activated, CAST(l_linenumber AS VARCHAR) AS order_number,
         CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS order_type_id
  FROM lineitem WHERE l_returnflag <> 'A'),
live_orders AS (
  SELECT o.*, t.name AS order_type_name, d.concept_uuid, d.concept_name, p.provider_uuid, p.provider_identifier, p.provider_name
  FROM line_orders o JOIN order_type t USING (order_type_id) JOIN dictionary d USING (concept_id)
  JOIN provider p ON p.provider_id = o.orderer),
obs AS (
  SELECT l_orderkey * 10 + l_linenumber + 1000000000 AS obs_id, l_partkey AS concept_id, l_orderkey AS encounter_id,
         l_orderkey AS order_id, CAST(NULL AS BIGINT) AS obs_group_id,
         CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS value_coded, CASE WHEN l_returnflag = 'A' THEN l_suppkey END AS value_drug,
         CAST(NULL AS VARCHAR) AS value_text, CASE WHEN l_returnflag = 'N' THEN l_quantity END AS value_numeric,
         CAST(NULL AS TIMESTAMP) AS value_datetime, l_shipdate AS obs_datetime,
         concat_ws('-', 'line', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS uuid, l_tax > 0.07 AS voided
  FROM lineitem
  UNION ALL
  SELECT conv_id * 100 + turn, conv_id + turn, conv_id, NULL, CASE WHEN turn > 0 THEN conv_id * 100 END,
         CASE WHEN role = 'system' THEN conv_id END, CASE WHEN role = 'assistant' AND turn > 3 THEN turn END,
         CASE WHEN role = 'user' THEN text END,
         CASE WHEN role = 'assistant' AND turn < 3 THEN CAST(length(text) AS DOUBLE) END,
         CASE WHEN turn = 3 THEN TIMESTAMP '2024-05-06 07:08:09' END, TIMESTAMP '2024-01-01 00:00:00',
         concat_ws('-', 'turn', conv_id, turn), CASE WHEN turn < 7 THEN false END
  FROM conversations),
described AS (
  SELECT o.*, q.concept_uuid, q.concept_name, a.concept_uuid AS answer_uuid, a.concept_name AS answer_name,
         CASE WHEN value_numeric IS NOT NULL THEN CAST(value_numeric AS VARCHAR) WHEN value_text IS NOT NULL THEN value_text
              WHEN value_drug IS NOT NULL THEN drug_name WHEN value_datetime IS NOT NULL THEN CAST(value_datetime AS VARCHAR) END AS value_not_coded,
         CASE WHEN value_numeric IS NOT NULL THEN 'numeric' WHEN value_text IS NOT NULL THEN 'text' WHEN value_drug IS NOT NULL THEN 'drug'
              WHEN value_datetime IS NOT NULL THEN 'datetime' WHEN value_coded IS NOT NULL THEN 'coded' END AS value_type
  FROM obs o JOIN dictionary q ON q.concept_id = o.concept_id LEFT JOIN dictionary a ON a.concept_id = o.value_coded
  LEFT JOIN drug d ON d.drug_id = o.value_drug
  WHERE voided IS NULL OR NOT voided),
members AS (
  SELECT c.obs_group_id, c.uuid,
         c.uuid || '|' || r.concept_name || ' : ' || c.concept_name || '|' || coalesce(c.value_type, '-') || '|' ||
         coalesce(c.value_not_coded, CASE WHEN c.answer_name IS NULL THEN '{}'
           ELSE '{"display":"' || c.answer_name || '","uuid":"' || c.answer_uuid || '"}' END) AS member
  FROM described c JOIN described r ON r.obs_id = c.obs_group_id AND r.obs_group_id IS NULL),
root_obs AS (
  SELECT r.*, m.members, coalesce(m.n_members, 0) AS n_members
  FROM described r LEFT JOIN (
    SELECT obs_group_id, string_agg(member, ';' ORDER BY uuid) AS members, count(*) AS n_members FROM members GROUP BY 1) m
    ON m.obs_group_id = r.obs_id
  WHERE r.obs_group_id IS NULL),
encounter_docs AS (
  SELECT CAST(e.encounter_id AS VARCHAR) AS doc_id, e.encounter_id, e.patient_id AS person_id, e.location_id, pe.uuid AS person_uuid, e.uuid,
         e.encounter_datetime, t.name AS type_name, f.uuid AS form_uuid, l.name AS location_name, v.visit_uuid,
         vt.name || ' @ ' || l2.name || ' - ' || CAST(v.date_started AS VARCHAR) AS visit_display,
         coalesce(p.providers, '') AS providers, coalesce(p.n, 0) AS n_providers,
         coalesce(o.orders, '') AS orders, coalesce(o.n, 0) AS n_orders,
         coalesce(b.observations, '') AS observations, coalesce(b.n, 0) AS n_obs
  FROM encounter e JOIN form f ON f.form_id = e.priority JOIN location l ON l.location_id = e.location_id
  JOIN visit v ON v.visit_id = e.encounter_id JOIN visit_type vt ON vt.visit_type_id = v.visit_type_id
  JOIN location l2 ON l2.location_id = v.location_id JOIN encounter_type t ON t.encounter_type_id = e.priority
  JOIN patient pa ON pa.patient_id = e.patient_id JOIN person pe ON pe.person_id = e.patient_id
  LEFT JOIN (SELECT encounter_id, count(*) AS n, string_agg(el, ';' ORDER BY uuid) AS providers FROM (
      SELECT DISTINCT l_orderkey AS encounter_id, concat_ws('-', 'ep', l_orderkey, l_suppkey) AS uuid, concat_ws('-', 'ep', l_orderkey, l_suppkey) || '|' || provider_name || '|' ||
             provider_identifier || ' - ' || provider_name AS el
      FROM lineitem JOIN provider ON provider_id = l_suppkey) GROUP BY 1) p ON p.encounter_id = e.encounter_id
  LEFT JOIN (SELECT encounter_id, count(*) AS n, string_agg(el, ';' ORDER BY order_uuid, date_activated, el) AS orders FROM (
      SELECT DISTINCT encounter_id, order_uuid, date_activated, order_uuid || '|' || order_number || '|' || concept_name || '|' ||
             concat_ws(' ', provider_identifier, provider_name) || '|' || order_type_name AS el FROM live_orders) GROUP BY 1) o
    ON o.encounter_id = e.encounter_id
  LEFT JOIN (SELECT encounter_id, count(*) AS n, string_agg(
      uuid || '|' || concept_name || '|' || coalesce(value_type || '=' || CASE WHEN value_coded IS NULL THEN value_not_coded
          WHEN answer_uuid IS NULL THEN '{}' ELSE '{"uuid":"' || answer_uuid || '","display":"' || answer_name || '"}' END, '-') || '|' || n_members, ';'
      ORDER BY obs_datetime, obs_id, uuid, value_type, value_not_coded) AS observations FROM root_obs GROUP BY 1) b ON b.encounter_id = e.encounter_id
  WHERE e.voided IS NULL OR NOT e.voided)
"""
