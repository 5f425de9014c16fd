"""Places where windows of a fixed length repeat, found through sampled anchors.

Items are the words or the bytes of a text. Every window of ``length`` consecutive items picks one
place inside it by a rule that looks only at the window, so that equal windows pick the same place.
Neighbouring windows mostly pick the same one; such a stretch of windows is a *piece*. All windows of
a piece contain the items around its place, whose hash is the *mark* of the piece. Hence windows can
only be equal if their marks are, and only marks that occur more than once are looked at further.

Rows with one mark are never gathered: equal pieces are one *class*, counted before the shuffle, and
windows of different classes are compared by the operators, each in its own way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.rows import keyed
from chartloom.llm.texts import Piece, mix, pieces, signed, span_hash, windows
from chartloom.session import written

PLACES = "mark long, piece long, doc long, version int, first int, size int, times int"
_INDEX = np.uint64((1 << 28) - 1)
NOWHERE = np.uint64((1 << 64) - 1)


def sampled(values: np.ndarray, first: np.ndarray, length: int, lead: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, their rows, and the place each picks: the smallest value, the leftmost of equal ones,
    among the ``width`` places that begin ``lead`` items into the window."""
    start, row = windows(first, length)
    if not len(start):
        return start, row, start
    n = len(values)
    packed = (values & ~_INDEX) | np.arange(n, dtype=np.uint64)
    grid = np.full(-(-n // width) * width + width, NOWHERE)
    grid[:n] = packed
    grid = grid.reshape(-1, width)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(grid, axis=1).ravel()
    at = start + lead
    return start, row, (np.minimum(after[at], before[at + width - 1]) & _INDEX).astype(np.int64)


def stretches(start, row, place, sums, length: int, lead: int, width: int) -> dict[str, np.ndarray]:
    """Pieces: first window, number of windows, row, mark, content hash, and how often it follows itself directly."""
    if not len(start):
        return {k: np.zeros(0, np.int64) for k in ("first", "size", "row", "times")} | {k: np.zeros(0, np.uint64) for k in ("mark", "piece")}
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    first, spot, own = start[at], place[at], row[at]
    size = np.diff(np.append(at, len(start)))
    mark = span_hash(sums, spot - lead, spot + length - lead - width + 1)
    piece = mix(span_hash(sums, first, first + size - 1 + length) + size.astype(np.uint64))
    # Text with a short period gives one piece over and over.
    new = np.ones(len(at), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (mark[1:] != mark[:-1]) | (own[1:] != own[:-1])
    keep = np.flatnonzero(new)
    times = np.diff(np.append(keep, len(at)))
    return {"first": first[keep], "size": size[keep], "row": own[keep], "times": times, "mark": mark[keep], "piece": piece[keep]}


def source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, version, doc_id, text``: the version tells rows apart that have one id and different texts."""
    return keyed(docs, doc_id, text).withColumn("version", F.shiftright("version", 32).cast("int"))


def places(texts: DataFrame, find: Callable[[Piece], tuple[dict[str, np.ndarray], np.ndarray]]) -> DataFrame:
    """All pieces. ``find`` gives those of some texts and the first item of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found, begin = find(part)
            rows = pa.array(found["row"])
            yield pa.RecordBatch.from_arrays(
                [
                    signed(found["mark"]),
                    signed(found["piece"]),
                    part.batch.column("doc").take(rows),
                    part.batch.column("version").take(rows),
                    *(pa.array(x.astype(np.int32)) for x in (found["first"] - begin[found["row"]], found["size"], found["times"])),
                ],
                [c.split()[0] for c in PLACES.split(", ")],
            )

    return texts.select("doc", "version", "text").mapInArrow(run, PLACES)


def repeated(found: DataFrame, across: bool) -> DataFrame:
    """Pieces whose mark occurs more than once (``across``: in more than one document), as a written table."""
    often = found.groupBy("mark").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.sum("times").alias("n"))
    often = often.where("low < high" if across else "n > 1").select("mark")
    return written(found.join(often, "mark", "left_semi"), "repeats")


def classes(pieces_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal pieces with their first place and number; those whose mark other classes have too, with how many there are."""
    every = written(
        pieces_.groupBy("mark", "piece").agg(
            F.min(F.struct("doc", "first", "version", "size")).alias("at"), F.sum("times").alias("n"), F.min("doc").alias("low")
        ),
        "classes",
    )
    crowd = every.groupBy("mark").agg(F.count("*").alias("others")).where("others > 1")
    return every, every.join(crowd, "mark")


def with_text(texts: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Texts joined with what is wanted from each: its places, gathered by document (at most one for each item of its text)."""
    gathered = wanted.groupBy("doc", "version").agg(F.collect_list(F.struct(*columns)).alias("wanted"))
    return texts.select("doc", "version", "text").join(gathered, ["doc", "version"]).select("text", "wanted")


def removals(texts: DataFrame, intervals: DataFrame) -> DataFrame:
    """Every text with the intervals (``start``, ``stop`` in items) that go; null if none do."""
    gathered = intervals.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    return texts.join(gathered, ["doc", "version"], "left").select("doc_id", "text", "gone")


def covered(n: int, gone: list[dict] | None) -> np.ndarray:
    """Which of ``n`` items lie in an interval."""
    edge = np.zeros(n + 1, np.int64)
    if gone:
        np.add.at(edge, [g["start"] for g in gone], 1)
        np.add.at(edge, [g["stop"] for g in gone], -1)
    return np.cumsum(edge[:-1]) > 0
