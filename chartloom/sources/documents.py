"""Target document databases: JSON documents by ``_id``.

All databases below a root are one keyed table with the column ``db``, so that the documents of
every location are written, or compared, by one job and not by a loop of jobs. The JSON text of a
document is one column beside its key, revision, patient and build date: documents of all types
share one schema, and the manifest is read without their bodies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.columns import row_type
from chartloom.functions.json import parse_doc_json, to_doc_json
from chartloom.sources.keyed import DELETED, KeyedTable

DB = "db"
BODY = "body"
BUCKETS = 8  # by person, in each database
MANIFEST = row_type(_id="string", _rev="string", person_id="bigint", build_date="timestamp")


def document_store(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, [DB, "_id"], partition_by=DB, bucket_by="person_id", buckets=BUCKETS)


def stored_form(df: DataFrame) -> DataFrame:
    """Key, the revision of the target that a document replaces, manifest columns and JSON text of documents.

    Revisions are given by the target; they are carried, never made here.
    """

    def optional(name: str, kind: str):
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

    body = to_doc_json(F.struct(*[c for c in df.columns if c not in (DB, "_rev", DELETED)]))
    return df.select(
        DB,
        "_id",
        optional("_rev", "string"),
        optional("person_id", "bigint"),
        optional("build_date", "timestamp"),
        F.coalesce(optional(DELETED, "boolean"), F.lit(False)).alias(DELETED),
        body.alias(BODY),
    )


def write_documents(
    df: DataFrame,
    root: str,
    db: str | None = None,
    bulk_size: int = 1_000_000,
    create: bool = True,
    writer: str | None = None,
    writer_batch: int | None = None,
) -> bool:
    """Write documents to one database, or each to the one its column ``db`` names.

    Documents with a stored ``_id`` are replaced, those with ``_deleted`` are removed. A file
    holds at most ``bulk_size`` documents. A database comes into being with its first write,
    unless ``create`` is off.
    """
    spark = df.sparkSession
    if db is not None:
        df = df.withColumn(DB, F.lit(db))
    if not create and not database_exists(spark, root, db):
        raise FileNotFoundError(f"no database {db}")
    return document_store(spark, root).upsert(stored_form(df), writer, writer_batch, maxRecordsPerFile=bulk_size)


def database_exists(spark: SparkSession, root: str, db: str) -> bool:
    store = document_store(spark, root)
    return store.exists() and not store.read().where(F.col(DB) == db).isEmpty()


def _stored(spark: SparkSession, root: str, db: str | None, people: DataFrame | None = None) -> DataFrame:
    rows = document_store(spark, root).read(people)
    return rows if db is None else rows.where(F.col(DB) == db)


def read_documents(spark: SparkSession, root: str, schema: T.StructType, db: str | None = None) -> DataFrame:
    """Stored documents, as far as ``schema`` names their fields; all databases have the column ``db``."""
    kept = ["_id", "_rev"] if db is not None else [DB, "_id", "_rev"]
    fields = T.StructType([f for f in schema.fields if f.name not in kept])
    parsed = _stored(spark, root, db).select(*kept, parse_doc_json(BODY, fields).alias("__doc"))
    return parsed.select(*kept, "__doc.*")


def read_manifest(
    spark: SparkSession,
    root: str,
    db: str | None = None,
    columns: Sequence[str] = ("_id", "_rev", "person_id", "build_date"),
    people: DataFrame | None = None,
) -> DataFrame:
    """Keys, revisions and build dates of the stored documents; no rows where nothing is stored.

    Without ``db`` the rows of all databases, with the column ``db``. With ``people`` only the documents of these, from the
    folders of their buckets.
    """
    if not document_store(spark, root).exists():
        nothing = spark.createDataFrame([], MANIFEST).withColumn(DB, F.lit(""))
        return nothing.select(DB, *columns) if db is None else nothing.select(*columns)
    rows = _stored(spark, root, db, people)
    return rows.select(DB, *columns) if db is None else rows.select(*columns)
