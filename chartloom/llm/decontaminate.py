"""Benchmark decontamination: one automaton over the windows of all test items, each text scanned once.

Texts and items are lower-cased (A-Z), and their words are runs of ASCII letters, digits and
characters beyond ASCII. A window is ``WINDOW`` consecutive words of an item; an item with fewer
words, but not none, is one window. A document word is hit if it lies inside an occurrence of a
window. Null and empty texts have no words and no hits; null items are ignored; equal windows of
several items count for each of them; rows with one id are judged each on its own.

Items are cut into runs of ``ITEM_WORDS`` windows, and these are dealt in Spark into blocks of about
``BLOCK_BYTES``, one automaton each, which bounds what a worker holds (some 550 bytes a byte of items). The
blocks lie in the shared folder; a task loads one after the other and scans a group of its texts with each, so texts are read
once, and neither items nor hits pass through the driver or a shuffle. Items and texts may be of any length that fits a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.rows import texts
from chartloom.llm.texts import Piece, pieces
from chartloom.session import work_dir, written

WINDOW = 13
ITEM_WORDS = 1_000
BLOCK_BYTES = 512 << 10
# Texts that are scanned with one block before the next is loaded, if there are several.
GROUP_BYTES = 64 << 20
# A document is contaminated if it has hits and they are at least this share of its words.
SHARE = 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    b + 32 if 65 <= b < 91 else b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256)
)

COLUMNS = "n_words long, n_hit long, items array<long>, spans array<struct<start:long,end:long>>"


def automaton(items: list[tuple[int, str]], window: int = WINDOW) -> ahocorasick.Automaton | None:
    """All windows of the items, each with the ids of its items and its number of words."""
    found: dict[str, tuple[int, set[int]]] = {}
    for item, text in items:
        words = text.encode().translate(_NORMAL).decode("latin-1").split(" ")
        words = [w for w in words if w]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            found.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].add(item)
    if not found:
        return None
    made = ahocorasick.Automaton()
    for key, value in found.items():
        made.add_word(key, value)
    made.make_automaton()
    return made


def scan(matcher: ahocorasick.Automaton | None, text: bytes) -> tuple[int, np.ndarray, list[int]]:
    """Number of words, which of them are hit, and the sorted ids of the items that occur."""
    words = text.translate(_NORMAL).split()
    hit = np.zeros(len(words), bool)
    items: set[int] = set()
    found = list(matcher.iter(f" {b' '.join(words).decode('latin-1')} ")) if matcher and words else []
    if found:
        ends = np.cumsum([len(w) + 1 for w in words])  # of the space behind each word
        last = np.searchsorted(ends, [end for end, _ in found])
        for k, (_, (size, ids)) in zip(last.tolist(), found, strict=True):
            hit[k - size + 1 : k + 1] = True
            items |= ids
    return len(words), hit, sorted(items)


def spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Hit runs as character offsets in the original text."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    if not len(edges):
        return []
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    at = lambda byte: len(text[:byte].decode())
    return [
        {"start": at(places[a][0]), "end": at(places[b - 1][1])}
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
    ]


_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_made: dict[tuple, ahocorasick.Automaton | None] = {}
Scan = tuple[int, np.ndarray, list[int]]


def _matcher(system: fs.FileSystem, block: tuple[str, ...], window: int) -> ahocorasick.Automaton | None:
    """The automaton of a block; a worker keeps the last one."""
    key = (block, window)
    if key not in _made:
        _made.clear()
        rows = [row for file in block for row in pq.ParquetFile(system.open_input_file(file)).read(["id", "text"]).to_pylist()]
        _made[key] = automaton([(row["id"], row["text"]) for row in rows], window)
    return _made[key]


def _blocks(path: str) -> tuple[fs.FileSystem, list[tuple[str, ...]]]:
    """The files of every block."""
    system, folder = fs.FileSystem.from_uri(path)
    by_block: dict[str, list[str]] = {}
    for found in system.get_file_info(fs.FileSelector(folder, recursive=True)):
        if found.base_name.endswith(".parquet"):
            by_block.setdefault(found.path.rsplit("/", 1)[0], []).append(found.path)
    return system, [tuple(sorted(by_block[b])) for b in sorted(by_block)]


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> str:
    """Folder with the items by blocks. No block exceeds ``block_bytes`` by more than one run of an item.

    The runs of an item share its windows out, none is in two and none is lost. They are dealt to parts by hash, as many
    as there are blocks of bytes, and cut into blocks by the running bytes of their part.
    """
    low = F.translate(F.col(f"`{text}`").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.regexp_extract_all(low, F.lit(_WORD.pattern.decode()), 0).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(ITEM_WORDS))
    runs = words.where("id IS NOT NULL AND size(words) > 0").select("id", "words", F.explode(starts).alias("start"))
    runs = runs.select("id", F.array_join(F.slice("words", F.col("start") + 1, ITEM_WORDS + window - 1), " ").alias("text")).distinct()
    rows = written(runs.withColumn("bytes", F.octet_length("text")), "item-runs")
    parts = (rows.agg(F.sum("bytes").alias("n")).first()["n"] or 0) // block_bytes + 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))
    earlier = Window.partitionBy("part").orderBy("id", "text").rowsBetween(Window.unboundedPreceding, -1)
    block = F.floor(F.coalesce(F.sum("bytes").over(earlier), F.lit(0)) / block_bytes)
    path = work_dir(items.sparkSession, "item-blocks")
    dealt.select("id", "text", "part", block.alias("block")).repartition("part", "block").write.partitionBy("part", "block").parquet(path)
    return path


def find(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items, spans`` (see the module for the rules)."""
    path = item_blocks(items, item_id, item_text, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _scanned(batches, path, window):
            yield _rows(piece.batch.column("doc_id").to_pylist(), [(piece.text(k), *row) for k, row in enumerate(found)])

    return texts(docs, doc_id, text).mapInArrow(run, f"doc_id long, {COLUMNS}")


def _rows(ids: list, found: list[tuple[bytes, int, np.ndarray, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([n for _, n, _, _ in found], pa.int64()),
            pa.array([int(hit.sum()) for _, _, hit, _ in found], pa.int64()),
            pa.array([items for *_, items in found], pa.list_(pa.int64())),
            pa.array([spans(text, hit) for text, _, hit, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ],
        ["doc_id", "n_words", "n_hit", "items", "spans"],
    )


def _groups(found: Iterator[Piece], limit: int) -> Iterator[list[Piece]]:
    """Pieces in turn, in groups of at least ``limit`` bytes."""
    group: list[Piece] = []
    size = 0
    for piece in found:
        group.append(piece)
        size += len(piece.data)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scanned(batches: Iterator[pa.RecordBatch], path: str, window: int, column: str = "text") -> Iterator[tuple[Piece, list[Scan]]]:
    """Pieces, and what all blocks together find in each of their texts."""
    system, blocks = _blocks(path)
    for group in _groups(pieces(batches, column), GROUP_BYTES if len(blocks) > 1 else 0):
        results: list[list[Scan]] = []
        for block in blocks or [None]:
            matcher = None if block is None else _matcher(system, block, window)
            found = [[scan(matcher, piece.text(k)) for k in range(len(piece))] for piece in group]
            results = [list(map(_united, old, new)) for old, new in zip(results, found, strict=True)] if results else found
        yield from zip(group, results, strict=True)
        # The next group begins with the block that is loaded.
        blocks.reverse()


def _united(old: Scan, new: Scan) -> Scan:
    return old[0], old[1] | new[1], sorted({*old[2], *new[2]})


def contaminated(share: int = SHARE):
    """Column over the result of ``find``: hits, and enough of them."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, all columns kept; rows are judged in place, nothing is shuffled."""
    path = item_blocks(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _scanned(batches, path, WINDOW, text):
            hits = [(n, int(hit.sum())) for n, hit, _ in found]
            yield piece.batch.filter(pa.array([not (hit and SHARE * hit >= n) for n, hit in hits], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
