"""Substring deduplication over bytes by longest-previous-factor arrays.

A byte is in a copy if a window of ``LENGTH`` bytes around it also occurs at another place. Marks of
sampled anchors (see ``repeats``) tell which windows can occur twice, and bring them together. There
the pieces of text with these windows are gathered, and all their suffixes are sorted whole, by prefix
doubling. In suffix order, the previous and the next suffix with a smaller position give the longest
earlier match of each suffix (its previous factor); with the order of positions turned round, the
longest later match. Factors of ``LENGTH`` bytes or more are the copies.

With ``keep="first"`` a window goes if it has an earlier match (by id, then place), so that the first
copy stays; with ``keep="none"`` if it has any other match. Matches never cross documents, overlapping
matches in one document count, and windows are judged on the input. Null and empty texts have no
bytes; texts shorter than a window stay whole; a null id counts as the largest; repeated rows are
copies of each other; other columns are not read. Cut characters are not mended: the result is bytes.

Windows of one mark are sorted in one task. Equal stretches of text are one class and sorted once, so
copies do not add to it; a mark of more than ``CROWD`` classes has its windows dealt out singly, by a
hash of their bytes, after those that occur once are left out; of such a window only the first suffix is asked for. If a window occurs in more than ``CROWD`` classes, its
places go to several tasks, and the first place of all goes to each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm import repeats
from chartloom.llm.texts import Piece, byte_sums, mix, pieces, signed, span_hash
from chartloom.session import written

LENGTH = 200
ANCHOR = 48  # bytes that all windows of a piece share
CROWD = 4096  # classes of a mark, or windows of a hash, that one task sorts
SORTED_BYTES = 1 << 17  # text whose suffixes are sorted at a time, unless one mark has more; some 80 bytes each
PACKED = 7  # bytes of the first ranks, nine bits each


def _find(piece: Piece):
    sums = byte_sums(piece.data)
    n = len(piece.data)
    values = np.full(n, repeats.NOWHERE)
    if n >= ANCHOR:
        at = np.arange(n - ANCHOR + 1)
        values[: len(at)] = mix(span_hash(sums, at, at + ANCHOR))
    width = LENGTH - ANCHOR + 1
    start, row, place = repeats.sampled(values, piece.offsets, LENGTH, 0, width)
    return repeats.stretches(start, row, place, sums, LENGTH, 0, width), piece.offsets


def previous_factors(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with one at a smaller place.

    Suffixes are in sorted order; ``common[i]`` is the prefix that i has in common with i - 1. The nearest
    smaller place on either side is found by jumps over suffixes already known to be larger.
    """
    n = len(place)
    best = np.zeros(n, np.int64)
    for turned in (False, True):
        p = place[::-1] if turned else place
        c = np.concatenate([[0], common[1:][::-1]]) if turned else common.copy()
        before = np.arange(n) - 1
        shared = c.astype(np.int64).copy()
        if n:
            shared[0] = 0
        open_ = np.flatnonzero((before >= 0) & (p[before] > p))
        while len(open_):
            over = before[open_]
            shared[open_] = np.minimum(shared[open_], shared[over])
            before[open_] = before[over]
            go = before[open_] >= 0
            open_ = open_[go]
            open_ = open_[p[before[open_]] > p[open_]]
        shared[before < 0] = 0
        best = np.maximum(best, shared[::-1] if turned else shared)
    return best


def suffix_order(texts: list[bytes], sizes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the first ``sizes`` suffixes of each text, equal ones by place, and the prefix that each has in common with the one before.

    All suffixes are sorted whole, by prefix doubling, with a factor of three: from the ranks by so many bytes, and those of the next ones,
    come the ranks by three times as many. An end is less than any byte. Ranks of all rounds are kept; from them, longest first, come common prefixes.
    """
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    n = len(data)
    ends = np.cumsum(lengths + 1) - 1
    code = data.astype(np.int64) + 1
    code[ends] = 0
    end = np.repeat(ends, lengths + 1)
    key, inside = code << 9 * (PACKED - 1), code > 0
    for k in range(1, min(PACKED, n)):
        inside = inside[:-1] & (code[k:] > 0)
        key[: n - k] |= (code[k:] * inside) << 9 * (PACKED - 1 - k)
    rank, todo = _refined(np.zeros(n, np.int64), np.arange(n), key)
    ranks, span = [rank], PACKED
    # As many ranks as a key of 63 bits holds.
    fold = 3 if n < 1 << 21 else 2
    while len(todo := todo[end[todo] - todo >= span]):
        key = rank[todo]
        for k in range(1, fold):
            key = key * (n + 1) + rank[np.minimum(todo + k * span, end[todo])]
        rank, todo = _refined(rank, todo, key)
        ranks.append(rank)
        span *= fold
    begins = ends - lengths
    at = np.repeat(begins, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((place, rank[at]))
    one, other = at[order[:-1]], at[order[1:]]
    stop, other_stop = end[one], end[other]
    shared = np.zeros(len(one), np.int64)
    for rank in reversed(ranks):
        go = np.arange(len(one))
        for _ in range(fold - 1):
            go = go[rank[np.minimum(one[go] + shared[go], stop[go])] == rank[np.minimum(other[go] + shared[go], other_stop[go])]]
            shared[go] += span
        span //= fold
    go = np.ones(len(one), bool)
    for _ in range(PACKED - 1):
        go &= code[np.minimum(one + shared, stop)] == code[np.minimum(other + shared, other_stop)]
        shared += go
    return order, np.concatenate([[0], np.minimum(shared, np.minimum(stop - one, other_stop - other))])


def _refined(rank: np.ndarray, todo: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks after those of ``todo``, which holds whole groups of one rank, are told apart by their keys; the ones still equal to others.

    A rank is the number of suffixes before its group.
    """
    order = np.argsort(key)
    todo, key, old = todo[order], key[order], rank[todo[order]]
    number = np.arange(len(todo))
    new, turn = np.ones(len(todo), bool), np.ones(len(todo), bool)
    new[1:], turn[1:] = key[1:] != key[:-1], old[1:] != old[:-1]
    first = np.maximum.accumulate(np.where(new, number, 0))
    rank = rank.copy()
    rank[todo] = old + first - np.maximum.accumulate(np.where(turn, number, 0))
    alone = new.copy()
    alone[:-1] &= new[1:]
    return rank, todo[~alone]


def window_order(texts: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for single windows of ``LENGTH`` bytes, of which no other suffix is asked for."""
    windows = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, LENGTH)
    order = np.lexsort((place, windows.view(f"S{LENGTH}").ravel()))
    rows = windows[order]
    differ = rows[1:] != rows[:-1]
    return order, np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)])


def matched(order: np.ndarray, common: np.ndarray, place: np.ndarray, keep: str) -> np.ndarray:
    """Which suffixes have a previous factor of ``LENGTH`` bytes or more, or a later one if none is to be kept."""
    ranks = place[order]
    long = previous_factors(ranks, common) >= LENGTH
    if keep == "none":
        long |= previous_factors(-ranks, common) >= LENGTH
    out = np.zeros(len(order), bool)
    out[order] = long
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted pieces."""
    for piece in pieces(batches):
        rows = []
        for k, wanted in enumerate(piece.batch.column("wanted").to_pylist()):
            begin = piece.offsets[k]
            for w in wanted:
                a = begin + w["first"] + w["step"]
                rows.append((w["route"], w["mark"], w["piece"], w["doc"], w["version"], w["first"], w["step"], w["n"], w["single"], piece.data[a : a + w["size"] - 1 + LENGTH].tobytes()))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(c, pa.int64()) for c in columns[:6]),
                *(pa.array(c, t) for c, t in zip(columns[6:], (pa.int32(), pa.int64(), pa.bool_(), pa.binary()), strict=True)),
            ],
            [c.split()[0] for c in _CUT.split(", ")],
        )


_CUT = "route long, mark long, piece long, doc long, version long, first long, step int, n long, single boolean, bytes binary"


def _sorter(keep: str, sorted_bytes: int):
    """Matches within each route; the rows of a route come one after another."""

    def matches(rows: list[tuple], single: bool) -> pa.RecordBatch:
        if single:
            # A window sent to several routes that are sorted together is one place.
            rows = list({(r[3], r[4], r[5] + r[6]): r for r in rows}.values())
        mark, piece, doc, version, first, step, n, _, texts = (list(c) for c in zip(*[r[1:] for r in rows], strict=True))
        sizes = np.array([len(t) - LENGTH + 1 for t in texts])
        owner = np.repeat(np.arange(len(rows)), sizes)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.array(step)[owner]
        by_place = np.lexsort((np.array(version)[owner], inner + np.array(first)[owner], np.array(doc)[owner]))
        place = np.empty(len(owner), np.int64)
        place[by_place] = np.arange(len(owner))
        order, common = window_order(texts, place) if single else suffix_order(texts, sizes, place)
        found = np.flatnonzero(matched(order, common, place, keep))
        owner, inner = owner[found], inner[found]
        begins = np.ones(len(found), bool)
        begins[1:] = (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)
        at = np.flatnonzero(begins)
        last = np.append(at[1:], len(found)) - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([mark[o] for o in owner[at]], pa.int64()),
                pa.array([piece[o] for o in owner[at]], pa.int64()),
                pa.array([n[o] for o in owner[at]], pa.int64()),
                pa.array(inner[at].astype(np.int32) if len(at) else [], pa.int32()),
                pa.array(inner[last].astype(np.int32) + 1 if len(at) else [], pa.int32()),
            ],
            ["mark", "piece", "n", "from", "to"],
        )

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        # Single windows have routes of their own, so they match none of the others.
        for single in (False, True):
            if own := [r for r in rows if r[8] == single]:
                yield matches(own, single)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, route = 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held > sorted_bytes and row[0] != route:
                    yield from done(rows)
                    rows, held = [], 0
                route = row[0]
                rows.append(row)
                held += len(row[-1])
        yield from done(rows)

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each window of the wanted pieces."""
    for piece in pieces(batches):
        sums = byte_sums(piece.data)
        starts, keys, steps = [], [], []
        for k, wanted in enumerate(piece.batch.column("wanted").to_pylist()):
            for w in wanted:
                starts.append(np.arange(w["size"]) + piece.offsets[k] + w["first"])
                steps.append(np.arange(w["size"], dtype=np.int32))
                keys.append((w["mark"], w["piece"]))
        key = np.repeat(np.array(keys, np.int64), [len(s) for s in starts], axis=0)
        start = np.concatenate(starts)
        yield pa.RecordBatch.from_arrays(
            [signed(span_hash(sums, start, start + LENGTH)), *(pa.array(np.ascontiguousarray(key[:, c])) for c in (0, 1)), pa.array(np.concatenate(steps))],
            ["hash", "mark", "piece", "step"],
        )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        rows = []
        for k, gone in enumerate(piece.batch.column("gone").to_pylist()):
            own = piece.data[piece.offsets[k] : piece.offsets[k + 1]]
            out = repeats.covered(len(own), gone)
            runs = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
            rows.append((len(own), int(out.sum()), runs, own[~out].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [piece.batch.column("doc_id"), *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)), pa.array([r[3] for r in rows], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _dealt(source: DataFrame, many: DataFrame, crowd: int) -> DataFrame:
    """Windows of crowded marks, one by one, by a hash of their bytes; those that occur once are left out."""
    hashes = written(repeats.with_text(source, many, ["mark", "piece", "first", "size"]).mapInArrow(_hashes, "hash long, mark long, piece long, step int"), "hashes")
    often = written(hashes.groupBy("hash").agg(F.count("*").alias("windows")).where("windows > 1"), "often")
    # Windows of a hash that is itself crowded go to several tasks, with many of them in each.
    parts = F.when(F.col("windows") > crowd, F.ceil(F.col("windows") * 2 / crowd)).otherwise(F.lit(1))

    def placed(chosen: DataFrame) -> DataFrame:
        found = hashes.join(chosen.withColumn("parts", parts), "hash").join(many.drop("size", "others"), ["mark", "piece"])
        return found.withColumn("part", F.pmod(F.xxhash64("mark", "piece", "step"), F.col("parts")))

    columns = ["hash", "part", "mark", "piece", "step", "doc", "version", "first", "n"]
    single = placed(often).select(*columns)
    shared = often.where(F.col("windows") > crowd)
    if not shared.isEmpty():
        # The first place of all goes to the tasks that do not have it.
        least = placed(shared).groupBy("hash", "parts").agg(F.min(F.struct("doc", (F.col("first") + F.col("step")).alias("place"), "version", "first", "step", "mark", "piece", "n", "part")).alias("at"))
        sent = least.select("hash", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).where("part <> at.part")
        single = single.unionByName(sent.select("hash", "part", *(F.col(f"at.{c}").alias(c) for c in columns[2:])))
    return single.select(*columns[2:], F.xxhash64("hash", "part").alias("route")).withColumns({"size": F.lit(1), "single": F.lit(True)})


def remove_copies(docs: DataFrame, keep: str = "first", doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD, sorted_bytes: int = SORTED_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes); ``keep`` is "first" or "none"."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep: {keep}")
    source = repeats.source(docs, doc_id, text)
    found = repeats.repeated(repeats.places(source, _find), across=False)
    every, crowded = repeats.classes(found)
    # Within a class: every place matches every other, the first one also earlier when it is not to be kept.
    own = found.join(every.where("n > 1").select("mark", "piece", "at"), ["mark", "piece"])
    start, stop = F.col("first"), F.expr(f"first + size * times - 1 + {LENGTH}")
    if keep == "first":
        is_first = (F.col("at.doc") == F.col("doc")) & (F.col("at.first") == F.col("first")) & (F.col("at.version") == F.col("version"))
        start = F.when(is_first, F.col("first") + F.col("size")).otherwise(F.col("first"))
    within = own.select("doc", "version", start.alias("start"), stop.alias("stop")).where(f"stop - start >= {LENGTH}")
    # Between classes of a mark: by suffix order.
    head = crowded.select(F.col("at.doc").alias("doc"), F.col("at.version").alias("version"), F.col("at.first").alias("first"), F.col("at.size").alias("size"), "mark", "piece", "n", "others")
    plain = head.where(F.col("others") <= crowd).withColumns({"route": F.col("mark"), "step": F.lit(0), "single": F.lit(False)})
    many = head.where(F.col("others") > crowd)
    columns = ["route", "mark", "piece", "doc", "version", "first", "step", "size", "n", "single"]
    wanted = plain.select(*columns)
    if not many.isEmpty():
        wanted = wanted.unionByName(_dealt(source, many, crowd).select(*columns))
    cut = repeats.with_text(source, wanted, columns)
    routed = cut.mapInArrow(_cut, _CUT).repartition("route").sortWithinPartitions("route")
    between = routed.mapInArrow(_sorter(keep, sorted_bytes), "mark long, piece long, n long, from int, to int")
    if keep == "none":
        between = between.where("n = 1")
    # A match between classes concerns the first place of a class; its other places go anyway.
    places = every.select("mark", "piece", F.col("at.doc").alias("doc"), F.col("at.version").alias("version"), F.col("at.first").alias("first"))
    between = between.join(places, ["mark", "piece"]).select("doc", "version", (F.col("first") + F.col("from")).alias("start"), (F.col("first") + F.col("to") - 1 + LENGTH).alias("stop"))
    return repeats.removals(source, within.unionByName(between)).mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
