"""Helpers for frames of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_ID = (1 << 63) - 1


def unused(columns: list[str]) -> str:
    """A beginning for helper columns that no column of a frame has, in any case of letters."""
    lead = "__"
    while any(c.lower().startswith(lead) for c in columns):
        lead += "_"
    return lead


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, so that other columns neither travel nor clash."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id (the largest number for null), text, and a text hash that tells rows of one id apart."""
    return texts(docs, doc_id, text).select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("version"), "doc_id", "text"
    )
