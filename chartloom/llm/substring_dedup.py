"""Substring deduplication over words by recompression.

Each round names runs of one symbol and pairs of adjacent symbols, beginning with the words. A name
is a hash of what it stands for, so all tasks of all rounds give equal parts the same name without
exchanging a dictionary. Which symbols pair depends on a bit of each one's name, and only symbols of at most
the round's span pair; so whether a border between symbols lasts depends on few words around it, and
equal word sequences have the same symbols but at their edges. Every window of ``WINDOW`` words picks
one of the symbols that are certain in its interior (the least name), with the words around it that
all windows picking it share. Spark counts these marks over all documents; those in several
documents lead to candidates, which are compared window by window through two independent hashes.

A word (`[^\\x20\\x09-\\x0D]+`) goes if a window that covers it also starts in a document with a
smaller id. Windows are judged on the input. A null id counts as the largest; null and empty texts have no words;
a text shorter than a window stays whole; rows with one id do not count as earlier than each other;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm import repeats
from chartloom.llm.texts import Piece, long_hash, long_sums, mix, pieces, prefix_hash, signed, span_hash, words
from chartloom.session import written

WINDOW = 50
RUN = 4  # longest run that becomes one symbol
SPANS = (1, 1, 2, 2)  # greatest span of a symbol that may pair, by round
REACH = RUN + sum(SPANS)  # words on either side on which a border depends
LARGEST = 4  # greatest span of a symbol after the rounds
PLACES = WINDOW - 2 * REACH - LARGEST + 1  # places in a window where a certain symbol may begin

_A, _B, _RUN = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xABC98388FB8FAC03), np.uint64(0x2545F4914F6CDD1D)


def symbols(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the symbols after all rounds and the item at which each begins."""
    n = len(names)
    if not n:
        return names, np.zeros(0, np.int64)
    # Runs: a maximal run of 2 to RUN equal words is one symbol; longer ones stay words, as their ends may be far away.
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    begin = new | np.repeat(size > RUN, size)
    name = np.where(np.repeat(size > RUN, size), names, mix(names + np.repeat(size, size).astype(np.uint64) * _RUN))
    name = np.where(np.repeat(size == 1, size), names, name)
    at = np.flatnonzero(begin)
    name, own = name[at], row[at]
    span = np.diff(np.append(at, n))
    for round_, limit in enumerate(SPANS):
        right = (mix(name + np.uint64(round_ + 1) * _B) & np.uint64(1)).astype(bool)
        pair = ~right[:-1] & right[1:] & (span[:-1] <= limit) & (span[1:] <= limit) & (own[:-1] == own[1:])
        first = np.flatnonzero(pair)
        name = name.copy()
        name[first] = mix(name[first] * _A + mix(name[first + 1]) + np.uint64(round_ + 1))
        keep = np.ones(len(name), bool)
        keep[first + 1] = False
        name, at, own = name[keep], at[keep], own[keep]
        span = np.diff(np.append(at, n))
    return name, at


def _word_names(piece: Piece) -> tuple:
    found = words(piece.data, piece.offsets)
    sums = long_sums(piece.data)
    return found, long_hash(sums, found.start, found.end)


def _find(piece: Piece):
    found, names = _word_names(piece)
    name, at = symbols(names, found.row())
    values = np.full(len(names), repeats.NOWHERE)
    values[at] = mix(name)
    start, row, place = repeats.sampled(values, found.first, WINDOW, REACH, PLACES)
    return repeats.stretches(start, row, place, prefix_hash(names), WINDOW, REACH, PLACES), found.first


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of each window of the wanted pieces."""
    for piece in pieces(batches):
        found, names = _word_names(piece)
        sums, other = prefix_hash(names), prefix_hash(mix(names + _A))
        starts, keys, lows, steps = [], [], [], []
        for k, wanted in enumerate(piece.batch.column("wanted").to_pylist()):
            for w in wanted:
                starts.append(np.arange(w["size"]) + found.first[k] + w["first"])
                steps.append(np.arange(w["size"], dtype=np.int32))
                keys.append((w["mark"], w["piece"], w["low"]))
        sizes = [len(s) for s in starts]
        start = np.concatenate(starts)
        key = np.repeat(np.array(keys, np.int64), sizes, axis=0)
        lows = key[:, 2]
        yield pa.RecordBatch.from_arrays(
            [
                signed(span_hash(sums, start, start + WINDOW)),
                signed(span_hash(other, start, start + WINDOW)),
                *(pa.array(np.ascontiguousarray(key[:, c])) for c in (0, 1)),
                pa.array(np.ascontiguousarray(lows)),
                pa.array(np.concatenate(steps)),
            ],
            ["h1", "h2", "mark", "piece", "low", "step"],
        )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        rows = []
        for k, gone in enumerate(piece.batch.column("gone").to_pylist()):
            parts = piece.text(k).split()  # at the separators of the definition, and no others, as these are bytes
            out = repeats.covered(len(parts), gone)
            kept = b" ".join([w for w, o in zip(parts, out.tolist(), strict=True) if not o]) if gone else b" ".join(parts)
            rows.append((len(parts), int(out.sum()), kept))
        yield pa.RecordBatch.from_arrays(
            [
                piece.batch.column("doc_id"),
                *(pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1)),
                pa.array([r[2].decode() for r in rows], pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the kept words, joined by one space."""
    source = repeats.source(docs, doc_id, text)
    found = repeats.repeated(repeats.places(source, _find), across=True)
    every, crowded = repeats.classes(found)
    own = found.join(every.select("mark", "piece", "low"), ["mark", "piece"])
    # An equal piece in an earlier document covers all windows of this one.
    later = own.where("doc > low").select("doc", "version", F.col("first").alias("start"), F.expr(f"first + size * times - 1 + {WINDOW}").alias("stop"))
    # The earliest documents of a class may share single windows with other classes of the mark.
    wanted = crowded.select(F.col("at.doc").alias("doc"), F.col("at.version").alias("version"), "mark", "piece", F.col("at.first").alias("first"), F.col("at.size").alias("size"), "low")
    single = written(
        repeats.with_text(source, wanted, ["mark", "piece", "first", "size", "low"]).mapInArrow(_window_rows, "h1 long, h2 long, mark long, piece long, low long, step int"),
        "windows",
    )
    least = single.groupBy("h1", "h2").agg(F.min("low").alias("least"), F.max("low").alias("most")).where("least < most")
    early = single.join(least, ["h1", "h2"]).where("least < low").select("mark", "piece", "step")
    steps = early.groupBy("mark", "piece").agg(F.collect_set("step").alias("steps"))
    edge = own.where("doc = low").join(steps, ["mark", "piece"])
    edge = edge.select("doc", "version", "first", "size", "times", F.explode("steps").alias("step"))
    edge = edge.select("doc", "version", "first", "size", "step", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("again"))
    edge = edge.select("doc", "version", F.expr("first + size * again + step").alias("start"), F.expr(f"first + size * again + step + {WINDOW}").alias("stop"))
    return repeats.removals(source, later.unionByName(edge)).mapInArrow(_apply, "doc_id long, n_words long, n_removed long, kept string")
