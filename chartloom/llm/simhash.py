"""SimHash near-duplicates: fingerprints of word shingles, and links of few differing bits found by pivot distance tables.

A fingerprint has a bit where over half of the XXH64 hashes of its shingles have it. Every fingerprint has a row of Hamming
distances to ``PIVOTS`` fixed reference fingerprints. If two fingerprints differ in ``d`` bits, none of their distances to
a reference differ by more than ``d`` (triangle inequality), so pairs whose largest difference is above ``d`` are discarded
and only the survivors are compared bit by bit.

Distances of unrelated fingerprints lie close together, so tables alone do not divide the work between tasks. Fingerprints
are therefore dealt first: of ``d + 2`` ranges of bits, two fingerprints of at most ``d`` differing bits have two equal
ranges at least, so each fingerprint goes to one bucket for each pair of ranges. A crowded bucket is split by the table
itself: into cells of the first distances, with each fingerprint also in the next cell of a coordinate if it is less than ``d`` from
its border. Equal fingerprints are one row throughout, and a cell emits a link to the least member of each component it finds,
at most one for each of its rows, however many pairs there are.

A null text, and one without a word, has the fingerprint zero, which links like any other. Repeated rows and equal ids each
give a row. A null id is the largest number inside and null outside. An empty table gives no rows; other columns are not
read. Texts are hashed shingle by shingle, so a text needs a few times its size in a task's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.components import components
from chartloom.llm.rows import LAST_ID, texts
from chartloom.llm.texts import mix
from chartloom.session import written

PIVOTS = 48
CROWD = 4096  # distinct fingerprints of a bucket beyond which it is split; the result does not depend on it
SEED = 42
_STEP = 1 << 17  # shingles, or pairs, that are held at once
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the spread numbers from one on."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of a text's shingles of ``size`` words, repeats included."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words])
    begin = np.concatenate([[0], end[:-1]])[: len(words) - size + 1].tolist()
    stop = (end[size - 1 :] - 1).tolist()
    n, counts, digest = len(begin), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, _STEP):
        h = [digest(joined[x:y], SEED) for x, y in zip(begin[k : k + _STEP], stop[k : k + _STEP], strict=True)]
        bits = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_buffer().to_pybytes() if t.is_valid else b""), size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, fp long")


def _ranges(n: int) -> list[tuple[int, int]]:
    """``n`` neighbouring ranges of the 64 bits: first bit and mask."""
    border = [64 * k // n for k in range(n + 1)]
    return [(x, (1 << (y - x)) - 1) for x, y in zip(border, border[1:], strict=False)]


def routes(fp: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of each fingerprint, one column for each pair of ranges; equal ranges give equal buckets, and the column is part of it."""
    part = [(fp >> np.uint64(x)) & np.uint64(m) for x, m in _ranges(bits + 2)]
    pairs = combinations(range(len(part)), 2)
    return np.stack([((part[i] << np.uint64(32) | part[j]) * np.uint64(64)) + np.uint64(k) for k, (i, j) in enumerate(pairs)], axis=1)


def distances(fp: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The table: a row of distances to all references for each fingerprint."""
    out = np.empty((len(fp), len(to)), np.int8)
    for k, p in enumerate(to):
        out[:, k] = np.bitwise_count(fp ^ p)
    return out


def cells(table: np.ndarray, bits: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and cells: combinations of the first ``levels`` distances in steps of ``bits + 1``, each with the next step if the border
    below it is in reach. Rows whose distances differ by at most ``bits`` share the cell of the larger steps."""
    row, cell = np.arange(len(table)), np.zeros(len(table), np.uint64)
    for k in range(levels):
        step, rest = np.divmod(table[row, k], bits + 1)
        over = rest > 0
        row, step = np.concatenate([row, row[over]]), np.concatenate([step, step[over] + 1])
        cell = mix(np.concatenate([cell, cell[over]]) * np.uint64(1 << 7) + step.astype(np.uint64) + np.uint64(1))
    return row, cell


def least_of(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least member of the component of each of ``n`` nodes, from batches of pairs."""
    low = np.arange(n)
    for a, b in pairs:
        while len(a):
            x, y = low[a], low[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(low, low[low]):
                low = low[low]
    return low


def linked(fp: np.ndarray, table: np.ndarray, bits: int, step: int = _STEP) -> np.ndarray:
    """Least member of the component of each fingerprint under links of at most ``bits`` differing bits."""
    order = np.argsort(table[:, 0], kind="stable")
    by_first = table[order]
    # Rows from each one on whose first distance is in reach.
    reach = np.searchsorted(by_first[:, 0], by_first[:, 0] + np.int8(bits), "right")

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lo, n = 0, len(order)
        count = reach - np.arange(n) - 1
        total = np.concatenate([[0], np.cumsum(count)])
        while lo < n:
            hi = max(int(np.searchsorted(total, total[lo] + step, "right")) - 1, lo + 1)
            a = np.repeat(np.arange(lo, hi), count[lo:hi])
            b = np.arange(len(a)) - np.repeat(total[lo:hi] - total[lo], count[lo:hi]) + a + 1
            for k in range(1, by_first.shape[1]):
                if not len(a):
                    break
                near = np.abs(by_first[a, k] - by_first[b, k]) <= bits
                a, b = a[near], b[near]
            a, b = order[a], order[b]
            same = np.bitwise_count(fp[a] ^ fp[b]) <= bits
            yield a[same], b[same]
            lo = hi

    return least_of(len(fp), pairs())


def _dealt(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            found = routes(fp.view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(np.repeat(fp, found.shape[1]))], ["route", "fp"])

    return run


def _split(bits: int, crowd: int):
    """Cells of the rows of buckets of ``members`` fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = pivots()
        for batch in batches:
            route, fp, members = (batch.column(c).to_numpy() for c in ("route", "fp", "members"))
            # Each coordinate leaves somewhat over a third of a bucket in its largest cell.
            levels = np.ceil(np.log2(np.maximum(members / crowd, 1)) / 1.25).astype(int)
            for n in np.unique(levels):
                at = np.flatnonzero(levels == n)
                for few in np.array_split(at, max(1, len(at) * 2 ** int(n) // _STEP)):
                    row, cell = cells(distances(fp[few].view(np.uint64), to[: max(n, 1)]), bits, int(n))
                    place = mix(cell ^ mix(route[few][row].view(np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64)), pa.array(fp[few][row])], ["cell", "fp"])

    return run


def _links(bits: int):
    """Links of each cell, whose rows follow each other; links of two cells of one hash are links all the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = pivots()

        def made(fp: np.ndarray) -> pa.RecordBatch:
            low = linked(fp.view(np.uint64), distances(fp.view(np.uint64), to), bits)
            moved = np.flatnonzero(low != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[low[moved]])], ["a", "b"])

        rest_cell, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            cell = np.concatenate([rest_cell, batch.column("cell").to_numpy()])
            fp = np.concatenate([rest, batch.column("fp").to_numpy()])
            border = np.flatnonzero(np.diff(cell)) + 1
            for x, y in zip([0, *border.tolist()], border.tolist(), strict=False):
                if y - x > 1:
                    yield made(fp[x:y])
            begin = int(border[-1]) if len(border) else 0
            rest_cell, rest = cell[begin:], fp[begin:]
        if len(rest) > 1:
            yield made(rest)

    return run


def groups(found: DataFrame, bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """``fp, component``: of every fingerprint that links to another, the one that names its component."""
    distinct = found.select("fp").distinct()
    dealt = written(distinct.mapInArrow(_dealt(bits), "route long, fp long"), "simhash-routes")
    sizes = dealt.groupBy("route").agg(F.count("*").alias("members")).where("members > 1")
    cell = dealt.join(sizes, "route").mapInArrow(_split(bits, crowd), "cell long, fp long")
    near = cell.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_links(bits), "a long, b long")
    links = components(near)
    return links.select(F.col("id").alias("fp"), "component").unionByName(links.select(F.col("component").alias("fp"), "component").distinct())


def link(docs: DataFrame, size: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the fingerprint and the least id reachable by links of at most ``bits`` differing bits."""
    rows = written(fingerprints(docs, size, doc_id, text), "fingerprints")
    first = rows.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(LAST_ID))).alias("low"))
    named = first.join(groups(rows, bits, crowd), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("low").alias("least"))
    of = written(named.join(least, "component").select("fp", "least"), "simhash-groups")
    return rows.join(of, "fp").select("doc_id", "fp", F.when(F.col("least") != LAST_ID, F.col("least")).alias("component_id"))
