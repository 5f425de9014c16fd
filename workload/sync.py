"""Cohorts, comparison with stored documents, staging and document stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.columns import row_type
from chartloom.operators.relational import missing_from, restrict_to, rows_of_entities_seen_at
from chartloom.operators.recent import RecentRows
from chartloom.operators.sync import (
    attach_rev,
    classify,
    cohort as cohort_at,
    cohorts,
    joiners,
    leavers,
    tombstones as mark_removed,
)
from chartloom.plans.rebuild import initial_load, nightly_delete, nightly_upsert, rebuild_all
from chartloom.plans.summaries import vitals_documents
from chartloom.session import work_dir
from chartloom.sources.bulk import read_bulk_files, write_bulk_files
from chartloom.sources.documents import read_documents, read_manifest, write_documents
from chartloom.sources.keyed import KeyedTable
from chartloom.sources.staging import read_staging, replace_staging, staging_table, upsert_staging
from workload.documents import vitals
from workload.registry import query
from workload.standin import built_at, load, uuid

TODAY, YESTERDAY = "1998-01-02", "1998-01-01"
DUE = "o_orderdate BETWEEN DATE '{0}' - INTERVAL 28 DAY AND DATE '{0}' + INTERVAL 2 DAY"
DUE_TODAY, DUE_YESTERDAY = DUE.format(TODAY), DUE.format(YESTERDAY)


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """Return visits: patient, place and date."""
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("person_id"),
        F.col("c_nationkey").alias("location_id"),
        F.col("o_orderdate").alias("rtc_date"),
    )


def day(text: str):
    return F.to_date(F.lit(text))


@query(
    f"""SELECT DISTINCT o_custkey AS person_id, c_nationkey AS location_id
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY}"""
)
def cohort(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts(summary(spark, sf), day(TODAY))


@query(
    f"""SELECT DISTINCT o_custkey AS person_id
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY} AND c_nationkey = 3"""
)
def cohort_of_location(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_at(summary(spark, sf), day(TODAY), 3)


@query(
    f"""SELECT user_id, event_id FROM events
        WHERE user_id IN (SELECT o_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY})"""
)
def cohort_restrict(spark: SparkSession, sf: str) -> DataFrame:
    members = cohorts(summary(spark, sf), day(TODAY)).withColumnRenamed("person_id", "user_id")
    return restrict_to(load(spark, sf, "events").select("user_id", "event_id"), members, "user_id")


@query(
    f"""WITH today AS (SELECT DISTINCT o_custkey FROM orders WHERE {DUE_TODAY}),
          yesterday AS (SELECT DISTINCT o_custkey FROM orders WHERE {DUE_YESTERDAY}),
          stored AS (SELECT DISTINCT user_id FROM events)
        SELECT o_custkey AS person_id, 'left' AS change FROM yesterday WHERE o_custkey NOT IN (SELECT o_custkey FROM today)
        UNION ALL
        SELECT o_custkey, 'joined' FROM today WHERE o_custkey NOT IN (SELECT user_id FROM stored)"""
)
def cohort_diff(spark: SparkSession, sf: str) -> DataFrame:
    today = cohorts(summary(spark, sf), day(TODAY)).select("person_id").distinct()
    yesterday = cohorts(summary(spark, sf), day(YESTERDAY)).select("person_id").distinct()
    stored = load(spark, sf, "events").select(F.col("user_id").alias("person_id"))
    left = leavers(yesterday, today).withColumn("change", F.lit("left"))
    return left.unionByName(joiners(today, stored).withColumn("change", F.lit("joined")))


@query(
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"""
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    returned = load(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return missing_from(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), returned, "o_orderkey")


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
       WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""
)
def entity_scope(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    seen = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return rows_of_entities_seen_at(orders, "o_custkey", seen).drop("o_orderpriority")


def order_docs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        uuid("order", "o_orderkey").alias("doc_id"),
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderdate").alias("build_date"),
    )


def order_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Stored are orders of two states; urgent ones with an older build date, low ones with none."""
    date = F.col("o_orderdate")
    stored = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_sub(date, 1).cast("timestamp_ntz")).when(
        F.col("o_orderpriority") != "5-LOW", date
    )
    return load(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        uuid("order", "o_orderkey").alias("_id"),
        uuid("1", "o_custkey").alias("_rev"),
        F.col("o_custkey").alias("person_id"),
        stored.alias("build_date"),
    )


@query(
    """SELECT 'order-' || o_orderkey AS doc_id, o_custkey AS person_id, o_orderdate AS build_date,
              CASE WHEN o_orderstatus <> 'P' THEN '1-' || o_custkey END AS _rev,
              CASE WHEN o_orderstatus = 'P' THEN 'insert' WHEN o_orderpriority = '1-URGENT' THEN 'update' ELSE 'unchanged' END AS status
       FROM orders"""
)
def sync_classify(spark: SparkSession, sf: str) -> DataFrame:
    return classify(order_docs(spark, sf), order_manifest(spark, sf))


@query(
    """SELECT 'order-' || o_orderkey AS _id, o_custkey AS person_id, o_orderdate AS build_date,
              CASE WHEN o_orderstatus <> 'P' THEN '1-' || o_custkey END AS _rev
       FROM orders"""
)
def revisions_attached(spark: SparkSession, sf: str) -> DataFrame:
    docs = order_docs(spark, sf).withColumnRenamed("doc_id", "_id")
    return attach_rev(docs, order_manifest(spark, sf))


@query(
    f"""SELECT 'order-' || o_orderkey AS _id, '1-' || o_custkey AS _rev, o_custkey AS person_id, true AS _deleted FROM orders
        WHERE o_orderstatus <> 'P'
          AND o_custkey IN (SELECT o_custkey FROM orders WHERE {DUE_YESTERDAY})
          AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE {DUE_TODAY})"""
)
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    today, yesterday = (cohorts(summary(spark, sf), day(d)).select("person_id") for d in (TODAY, YESTERDAY))
    manifest = order_manifest(spark, sf).drop("build_date")
    return mark_removed(manifest, leavers(yesterday, today))


# -- stores -----------------------------------------------------------------------------------


@query("SELECT 'order-' || o_orderkey AS doc_id, o_custkey AS person_id, o_orderdate AS build_date FROM orders")
def staging_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "staging")
    replace_staging(order_docs(spark, sf), root, "orders")
    return read_staging(spark, root, "orders")


@query(
    """SELECT 'order-' || o_orderkey AS doc_id, o_custkey AS person_id,
              CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2021-01-01 00:00:00'
                   WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '2022-01-01 00:00:00' ELSE o_orderdate END AS build_date
       FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""
)
def staging_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A base, two appends over it and a removal; the last write of a key wins."""
    root = work_dir(spark, "staging")
    orders = load(spark, sf, "orders")
    docs = order_docs(spark, sf)

    def dated(condition: str, date: str) -> DataFrame:
        ids = orders.where(condition).select(uuid("order", "o_orderkey").alias("doc_id"))
        return restrict_to(docs, ids, "doc_id").withColumn("build_date", F.to_timestamp_ntz(F.lit(date)))

    kept = orders.where("o_orderstatus <> 'O'").select(uuid("order", "o_orderkey").alias("doc_id"))
    replace_staging(restrict_to(docs, kept, "doc_id"), root, "orders")
    upsert_staging(dated("o_orderpriority = '1-URGENT'", "2022-01-01 00:00:00"), root, "orders")
    upsert_staging(dated("o_orderstatus = 'O'", "2021-01-01 00:00:00"), root, "orders")
    low = orders.where("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
    table = staging_table(spark, root, "orders")
    table.delete(low.select(uuid("order", "o_orderkey").alias("doc_id")))
    return table.read()


ORDER_DOC = row_type(_id="string", _rev="string", person_id="bigint", build_date="timestamp", rewritten="boolean")


@query(
    """SELECT 'order-' || o_orderkey AS _id, o_custkey AS person_id, o_orderdate AS build_date,
              '1-' || o_custkey AS revision, o_orderpriority = '1-URGENT' AS rewritten
       FROM orders WHERE o_orderpriority <> '5-LOW'"""
)
def doc_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write a database, write some documents again, remove others."""
    root = work_dir(spark, "documents")
    given = F.concat(F.lit("1-"), F.col("person_id").cast("string"))
    docs = order_docs(spark, sf).withColumnRenamed("doc_id", "_id").withColumns({"_rev": given, "rewritten": F.lit(False)})
    orders = load(spark, sf, "orders")

    def ids(condition: str) -> DataFrame:
        return orders.where(condition).select(uuid("order", "o_orderkey").alias("_id"))

    write_documents(docs, root, "clinic", bulk_size=5_000)
    stored = read_manifest(spark, root, "clinic", ["_id", "_rev"])
    again = restrict_to(attach_rev(docs, stored), ids("o_orderpriority = '1-URGENT'"), "_id").withColumn("rewritten", F.lit(True))
    write_documents(again, root, "clinic")
    stored = read_manifest(spark, root, "clinic", ["_id", "_rev"])
    removed = restrict_to(stored, ids("o_orderpriority = '5-LOW'"), "_id").withColumn("_deleted", F.lit(True))
    write_documents(removed, root, "clinic")
    return read_documents(spark, root, ORDER_DOC, "clinic").select(
        "_id",
        "person_id",
        F.col("build_date").cast("timestamp_ntz").alias("build_date"),
        F.col("_rev").alias("revision"),
        "rewritten",
    )


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'two' ELSE 'one' END AS writer, o_custkey AS v
       FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0"""
)
def two_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers of one table; the later commit wins where both wrote."""
    path = work_dir(spark, "table")
    one, two = (KeyedTable(spark, path, "k") for _ in range(2))
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    one.upsert(rows.where("k % 2 = 0").withColumn("writer", F.lit("one")), "one", 0)
    two.upsert(rows.where("k % 3 = 0").withColumn("writer", F.lit("two")), "two", 0)
    return one.read().select("k", "writer", "v")


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'stream' ELSE 'load' END AS writer, o_custkey AS v FROM orders
       WHERE o_orderstatus <> 'P' OR o_orderkey % 3 = 0"""
)
def load_during_appends(spark: SparkSession, sf: str) -> DataFrame:
    """A full load stands for what there was when it began to read; what a stream commits meanwhile stays."""
    table = KeyedTable(spark, work_dir(spark, "table"), "k")
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), "o_orderstatus")
    table.upsert(rows.drop("o_orderstatus").withColumn("writer", F.lit("before")), "before", 0)
    seen = table.version()
    loaded = rows.where("o_orderstatus <> 'P'").drop("o_orderstatus").withColumn("writer", F.lit("load"))
    table.upsert(rows.where("k % 3 = 0").drop("o_orderstatus").withColumn("writer", F.lit("stream")), "stream", 0)
    table.replace(loaded, seen=seen)
    return table.read().select("k", "writer", "v")


@query(
    """SELECT 'vitals_' || user_id || '_' || event_id AS doc_id, user_id AS person_id, CASE WHEN event_type = 'click' THEN -1 ELSE value END AS weight
       FROM events WHERE user_id % 40 = 3"""
)
def staging_by_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Staged documents of some people, from the buckets of these; some were staged again."""
    root = work_dir(spark, "staging")
    docs = vitals_documents(vitals(spark, sf), built_at())
    replace_staging(docs, root, "vitals")
    clicks = load(spark, sf, "events").where("event_type = 'click'").select(F.col("event_id").alias("encounter_id"))
    upsert_staging(restrict_to(docs, clicks, "encounter_id").withColumn("weight", F.lit(-1.0)), root, "vitals")
    people = load(spark, sf, "events").where("user_id % 40 = 3").select(F.col("user_id").alias("person_id"))
    return read_staging(spark, root, "vitals", people=people).select("doc_id", "person_id", "weight")


@query(
    """SELECT DISTINCT 'order-' || o_orderkey AS doc_id FROM orders
       WHERE o_orderpriority = '1-URGENT' OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""
)
def changes_since(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that commits after a full load wrote or removed, also after they were folded."""
    table = staging_table(spark, work_dir(spark, "staging"), "orders")
    docs, orders = order_docs(spark, sf), load(spark, sf, "orders")

    def ids(condition: str) -> DataFrame:
        return orders.where(condition).select(uuid("order", "o_orderkey").alias("doc_id"))

    table.replace(docs)
    seen = table.version()
    table.upsert(restrict_to(docs, ids("o_orderpriority = '1-URGENT'"), "doc_id"))
    table.delete(ids("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'"))
    table.compact()
    return table.changes_since(seen)


@query(
    """SELECT user_id, event_id, ts, value FROM events WHERE event_type <> 'error'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10"""
)
def recent_ten_by_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The ten latest events of every person, kept up over four batches; the last one removes errors, recent ones among them."""
    events = load(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type")
    part = F.col("event_id") % 3
    store = RecentRows(spark, work_dir(spark, "recent"), "user_id", "ts", "event_id")
    for number in range(4):
        here = events.where(part == number) if number < 3 else events.where("event_type = 'error'").withColumn("_deleted", F.lit(True))
        history = events.where(part <= number) if number < 3 else events.where("event_type <> 'error'")
        store.merge(here, lambda people, rows=history: restrict_to(rows, people, "user_id"), "events", number)
    return store.read().select("user_id", "event_id", "ts", "value")


@query(
    """SELECT 'nation-' || c_nationkey AS db, 'order-' || o_orderkey AS _id,
              CASE WHEN o_orderstatus <> 'P' THEN '1-' || o_custkey END AS revision, o_orderstatus = 'F' AS removed,
              CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS person_id
       FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def bulk_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and removals as JSON lines by database, in two batches of which the first is written twice."""
    customer = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), uuid("nation", "c_nationkey").alias("db"))
    docs = load(spark, sf, "orders").join(customer, "o_custkey").select(
        "db",
        uuid("order", "o_orderkey").alias("_id"),
        F.when(F.col("o_orderstatus") != "P", uuid("1", "o_custkey")).alias("_rev"),
        F.col("o_custkey").alias("person_id"),
        (F.col("o_orderstatus") == "F").alias("_deleted"),
        F.col("o_orderkey").alias("n"),
    )
    root = work_dir(spark, "bulk")
    for batch, condition in (("first", "n % 2 = 0"), ("second", "n % 2 = 1"), ("first", "n % 2 = 0")):
        write_bulk_files(docs.where(condition).drop("n"), root, batch, bulk_size=1_000)
    line = F.from_json("value", row_type(_id="string", _rev="string", person_id="bigint", _deleted="boolean"))
    return read_bulk_files(spark, root).select("db", line.alias("d")).select(
        "db", "d._id", F.col("d._rev").alias("revision"), F.coalesce("d._deleted", F.lit(False)).alias("removed"), "d.person_id"
    )


# -- whole jobs -------------------------------------------------------------------------------


def placed_vitals(spark: SparkSession, sf: str) -> DataFrame:
    """Vitals documents at the place of the patient."""
    customer = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("person_id"), F.col("c_nationkey").alias("location_id")
    )
    return vitals_documents(vitals(spark, sf), built_at()).join(customer, "person_id")


RECENT_VITALS = """recent AS (
          SELECT user_id, event_id, ts FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10)"""


@query(
    f"""WITH members AS (
          SELECT DISTINCT o_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY}),
          {RECENT_VITALS}
        SELECT 'vitals_' || user_id || '_' || event_id AS _id, user_id AS person_id, event_id AS encounter_id
        FROM recent JOIN customer ON c_custkey = user_id
        WHERE user_id IN (SELECT o_custkey FROM members) AND c_nationkey = 3"""
)
def first_load(spark: SparkSession, sf: str) -> DataFrame:
    members = cohorts(summary(spark, sf), day(TODAY)).select("person_id").distinct()
    return initial_load("vitals", placed_vitals(spark, sf), members, 3).select("_id", "person_id", "encounter_id")


VITALS_DOC = row_type(_id="string", _rev="string", person_id="bigint", encounter_id="bigint", weight="double")


@query(
    f"""WITH today AS (
          SELECT DISTINCT o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE {DUE_TODAY}),
          {RECENT_VITALS}
        SELECT 'vitals_' || r.user_id || '_' || r.event_id AS _id, 'location-' || c_nationkey AS db,
               r.user_id AS person_id, r.event_id AS encounter_id, value + 1 AS weight
        FROM today m JOIN recent r ON r.user_id = m.o_custkey JOIN events e ON e.event_id = r.event_id"""
)
def nightly_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Two nights: yesterday's cohorts are stored, staging is rebuilt, today's are stored and leavers removed."""
    staging, target = work_dir(spark, "staging"), work_dir(spark, "documents")
    visits = summary(spark, sf)
    docs = placed_vitals(spark, sf)
    rebuild_all({"vitals": lambda: docs}, staging)
    nightly_upsert(spark, staging, target, visits, day(YESTERDAY), ["vitals"])
    rebuilt = docs.withColumns(
        {"weight": F.col("weight") + 1, "build_date": F.to_timestamp_ntz(F.lit("2020-02-02 00:00:00"))}
    )
    rebuild_all({"vitals": lambda: rebuilt}, staging)
    nightly_upsert(spark, staging, target, visits, day(TODAY), ["vitals"])
    nightly_delete(spark, target, visits, day(TODAY), day(YESTERDAY))
    return read_documents(spark, target, VITALS_DOC).select("_id", "db", "person_id", "encounter_id", "weight")
