"""Line deduplication by content-defined chunks, with DataFrame functions only.

The lines of a text are hashed, and a rolling hash over the last ``ROLL`` line hashes chooses the lines
after which a chunk ends. As the choice depends on a few lines only, inserted or removed lines move
the borders near them and no others, so that copied passages give equal chunks at any place. A border
does not directly follow another one, so chunks have two lines or more but at the ends of a text and
of what lies between two texts' common parts.

Chunks of at least ``LINES`` lines and one word that occur more than once are removed but for their first
place (least id, then text hash, then place), after their bytes are compared: candidates are found by hash,
and only equal texts are copies of each other. The other lines keep their order.

A null text stays null, an empty one empty; texts without a repeated chunk stay byte for byte. A null id
counts as the largest; rows with one id and one text are one text and keep or lose the same chunks. Other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.rows import LAST_ID, texts, unused
from chartloom.session import written

ROLL = 2
DIVISOR = 3
LINES = 2

_MODULUS = (1 << 31) - 1
_FACTOR = 1_000_003


def _previous(array: str, start: Column) -> Column:
    """The array moved by one place, with ``start`` in front."""
    return F.slice(F.concat(F.array(start), F.col(array)), F.lit(1), F.size(array))


def with_chunks(docs: DataFrame, text: Column, lead: str = "__") -> DataFrame:
    """The frame with ``__parts`` (``lead`` and "parts"): the chunks of ``text`` in order, as ``body`` and ``n_lines``; null if the text is.

    Each step is a column of its own that the next one reads more than once, so arrays are made once per row.
    A one-row generator comes last: filters on what follows are not moved below it, where they would
    repeat all steps.
    """
    columns = docs.columns
    keep = [F.col(f"`{c}`") for c in columns]
    lines = docs.select(*keep, F.split(text, "\n", -1).alias(f"{lead}lines"))
    # The first seven hex digits of each line's md5 are its hash.
    hashes = lines.select(*keep, f"{lead}lines", F.transform(f"{lead}lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")).alias(f"{lead}hashes"))
    rolled = F.zip_with(_previous(f"{lead}hashes", F.lit(0).cast("long")), f"{lead}hashes", lambda before, h: (before * _FACTOR + h) % _MODULUS % DIVISOR == 0)
    chosen = hashes.select(*keep, f"{lead}lines", rolled.alias(f"{lead}chosen"))
    flags = F.zip_with(_previous(f"{lead}chosen", F.lit(False)), f"{lead}chosen", lambda before, c: c & ~before)
    marked = F.filter(F.transform(flags, lambda c, i: F.when(c, i + 1)), lambda e: e.isNotNull())
    ends = chosen.select(*keep, f"{lead}lines", F.array_union(marked, F.array(F.size(f"{lead}chosen"))).alias(f"{lead}ends"))
    part = lambda before, e: F.struct(F.array_join(F.slice(f"{lead}lines", before + 1, e - before), "\n").alias("body"), (e - before).alias("n_lines"))
    parts = F.zip_with(_previous(f"{lead}ends", F.lit(0)), f"{lead}ends", part)
    made = F.struct(F.when(F.col(f"{lead}lines").isNotNull(), parts).alias(f"{lead}parts"))
    return ends.select(*keep, F.inline_outer(F.array(made)))


def _worth(body: str = "body") -> Column:
    return (F.col("n_lines") >= LINES) & F.col(body).rlike(r"[^\x20\x09-\x0D]")


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, gone``: by text, the numbers of the chunks that are later copies of an equal one."""
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    cut = with_chunks(keyed.where(F.contains("text", F.lit("\n"))), F.col("text"))
    every = cut.select("doc", "version", F.posexplode("__parts").alias("chunk", "part")).select("doc", "version", "chunk", "part.body", "part.n_lines")
    every = every.where(_worth()).withColumn("hash", F.xxhash64("body"))
    often = every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    copies = written(every.join(often, "hash", "left_semi"), "chunks")
    place = F.struct("doc", "version", "chunk")
    # Equal bytes, not only equal hashes, make a copy; equal bodies are folded before they are shuffled.
    first = copies.groupBy("hash", "body").agg(F.min(place).alias("first"))
    found = copies.join(first, ["hash", "body"]).where(place != F.col("first"))
    return found.groupBy("doc", "version").agg(F.collect_set("chunk").alias("gone"))


def _thinned(docs: DataFrame, doc_id: str, text: str, lead: str = "__") -> DataFrame:
    """The documents with ``__gone`` (lines removed, null if none) and ``__left`` (what remains of the text); the names begin with ``lead``."""
    gone = repeated_chunks(docs, doc_id, text).select(F.col("doc").alias(f"{lead}doc"), F.col("version").alias(f"{lead}version"), F.col("gone").alias(f"{lead}chunks"))
    marked = docs.withColumns({f"{lead}doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)), f"{lead}version": F.xxhash64(text)})
    joined = marked.join(gone, [f"{lead}doc", f"{lead}version"], "left")
    cut = with_chunks(joined, F.when(F.col(f"{lead}chunks").isNotNull(), F.col(text)), lead)
    inside = lambda yes: F.filter(f"{lead}parts", lambda _, i: F.array_contains(f"{lead}chunks", i) if yes else ~F.array_contains(f"{lead}chunks", i))
    left = F.array_join(F.transform(inside(False), lambda p: p["body"]), "\n")
    removed = F.aggregate(inside(True), F.lit(0), lambda total, p: total + p["n_lines"])
    has = F.col(f"{lead}chunks").isNotNull()
    made = F.struct(F.when(has, removed).alias(f"{lead}gone"), F.when(has, left).otherwise(F.col(text)).alias(f"{lead}left"))
    return cut.select(*[F.col(f"`{c}`") for c in cut.columns], F.inline_outer(F.array(made)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without later copies of chunks, all columns kept; those that lose their last word are gone."""
    lead = unused(docs.columns)
    thinned = _thinned(docs, doc_id, text, lead)
    kept = thinned.where(F.col(f"{lead}gone").isNull() | F.col(f"{lead}left").rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*[F.col(f"{lead}left").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def summary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, kept``: lines, removed lines and the remaining text of every row."""
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    return _thinned(texts(docs, doc_id, text), "doc_id", "text").select(
        "doc_id", lines.alias("n_lines"), F.coalesce("__gone", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("__left", F.lit("")).alias("kept")
    )
