"""Similarity join of word n-gram sets through R-trees over count vectors.

The shingles of a text are hashed into ``DIMENSIONS`` groups; the numbers of shingles by group are a
point. Two sets share at most the sum of the smaller of each pair of coordinates, and so do all sets
below a tree node whose largest coordinates are taken instead; branches and points whose bound is too
small for the similarity are skipped, as are pairs whose bound in more groups is; the others are verified on the sets.

Trees are built where similar sets can be (a bucket of more than ``BUCKET`` sets makes one cluster without a tree). If the similarity of two sets is at least t, they differ in
at most a share (1 - t) / t of the smaller one; so when shingles are dealt to more parts than that, one
part of both is the same. Texts with an equal part make a bucket, whose tree tells which of
them the bound allows to be similar; those that this connects make a cluster. In a cluster, pairs that its
tree lets pass are verified. Which numbers of parts a text uses depends on its size alone, so that
similar sizes meet; a text whose shingles fill too few of the parts also uses the next finer number.

Only connectivity is asked for: within a tree, pairs that are connected already are not verified. Equal
sets are one point: a name that sets share by chance, as a second hash shows, is not used (see ``Names``). A cluster of more than ``CROWD`` sets is not gathered: its sets are compared with
one of them, its hub, each in a task of its own; those similar to the hub are connected, and only the
others are compared with everything, in blocks.

Words are runs `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A text with fewer words than a shingle has
one shingle, all its words; a null or empty text has none and links with nothing. A null id counts as
the largest; rows with one id are judged each by its own text; other columns are not read.

Texts are hashed once: one pass gives the set of each row and, in blocks, the parts of each different set. A block has the parts of
one of ``ROUTES`` ranges of their hashes, 32 bits each behind those of the range, and 16 bits for the set, whose number goes on from that of the block.
Parts that are equal in 44 bits by chance only make sets meet. Texts that are asked for again are found by a filter
of their ids and hashes (``members``), so the others are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.components import components
from chartloom.llm.members import Members, members
from chartloom.llm.rows import LAST_ID, keyed, unused
from chartloom.llm.texts import LOWER, Piece, long_hash, long_sums, mix, pieces, windows, words
from chartloom.session import written

DIMENSIONS = 128
FINE = 1024
LEAF = 16
CROWD = 1000
BUCKET = 4096
ROUTES = 4096  # ranges of the hashes of parts
# Parts, and sets, of which a task makes blocks at a time; the latter have 16 bits.
BLOCK_PARTS = 2 << 20
BLOCK_SETS = 1 << 16
GROWTH = 1.5  # of sizes from one number of parts to the next

_STEP = np.uint64(0xD1342543DE82EF95)


def shingle_sets(piece: Piece, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = LOWER[piece.data]
    found = words(data, piece.offsets)
    names = long_hash(long_sums(data), found.start, found.end)
    start, row = windows(found.first, size)
    all_ = np.zeros(len(start), np.uint64)
    for k in range(size):
        all_ = all_ * _STEP + names[start + k]
    all_ = mix(all_ + np.uint64(size))
    bounds = np.searchsorted(row, np.arange(len(piece) + 1)).tolist()
    out = []
    for k, n in enumerate(found.count().tolist()):
        if 0 < n < size:
            one = np.zeros(1, np.uint64)
            for name in names[found.first[k] : found.first[k] + n]:
                one = one * _STEP + name
            out.append(mix(one + np.uint64(n)))
        else:
            out.append(_distinct(all_[bounds[k] : bounds[k + 1]]))
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values, each once."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


@cache
def level_sizes() -> tuple[int, ...]:
    """Largest set size of each level; beyond the last, sizes go on by the same factor."""
    sizes = [24]
    while sizes[-1] < 1 << 40:
        sizes.append(int(sizes[-1] * GROWTH))
    return tuple(sizes)


def level(n: int) -> int:
    return int(np.searchsorted(level_sizes(), n))


def parts_of(k: int, t: float) -> tuple[int, int]:
    """Number of parts of a level, and how many of them two similar sets may differ in."""
    differ = int(level_sizes()[k] * (1 - t) / t + 1e-9)
    return int(1.08 * (differ + 1)) + 1, differ


def signatures(own: np.ndarray, t: float, mixed: np.ndarray | None = None) -> np.ndarray:
    """A hash of each part of a set, for every level that a similar set may use too; ``mixed`` is ``mix(own * _STEP)`` where it is known."""
    n = len(own)
    if not n:
        return own
    out = []
    mixed = mix(own * _STEP) if mixed is None else mixed
    todo = [(k, 0) for k in {level(n), level(max(1, int(np.ceil(n * t - 1e-9))))}]
    for k, finer in todo:
        parts, differ = parts_of(k, t)
        parts <<= finer
        if k == 0 or parts > level_sizes()[k]:
            # As many parts as shingles: each shingle is a part of its own.
            out.append(mix(own + np.uint64(k + 1) * _STEP))
            continue
        part = mix(own ^ np.uint64(k + 1)) % np.uint64(parts)
        part = part.astype(np.uint16) if parts <= 1 << 16 else part  # these are sorted faster
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        filled = part[first].astype(np.uint64)
        total = np.add.reduceat(mixed[order], first)
        out.append(mix(total + (np.uint64(k * 64 + finer) << np.uint64(40)) + filled))
        if len(filled) <= differ:
            # Of two similar sets with so few filled parts the equal part may be an empty one; both go on like this.
            todo.append((k, finer + 1))
    return np.concatenate(out)


def counts(own: np.ndarray, groups_: int = DIMENSIONS) -> np.ndarray:
    """How many shingles each group has."""
    return np.bincount((own >> np.uint64(7)).astype(np.int64) & (groups_ - 1), minlength=groups_)


def needed(a, b, t: float):
    """Shared shingles that two sets of these sizes need: shared / (a + b - shared) >= t."""
    return np.ceil((a + b) * t / (1 + t) - 1e-9)


class Tree:
    """An R-tree over count vectors, packed by halving along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # A count of 65,535 may be a larger one that was cut, so it bounds nothing.
        self.points, self.sizes = np.where(points >= 65535, 1 << 40, points), sizes
        self.nodes: list[tuple[np.ndarray, int, int, np.ndarray | tuple[int, int]]] = []
        self.root = self._pack(np.arange(len(points))) if len(points) else -1

    def _pack(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        high, low, large = own.max(axis=0), int(self.sizes[rows].min()), int(self.sizes[rows].max())
        if len(rows) <= LEAF:
            below: np.ndarray | tuple[int, int] = rows
        else:
            axis = int((high - own.min(axis=0)).argmax())
            order = rows[np.argsort(own[:, axis], kind="stable")]
            below = (self._pack(order[: len(order) // 2]), self._pack(order[len(order) // 2 :]))
        self.nodes.append((high, low, large, below))
        return len(self.nodes) - 1

    def near(self, point: np.ndarray, size: int, t: float) -> np.ndarray:
        """Rows whose bound allows the similarity."""
        point = np.where(point >= 65535, 1 << 40, point)
        out, todo = [], [self.root] if self.root >= 0 else []
        while todo:
            high, low, large, below = self.nodes[todo.pop()]
            if large < size * t - 1e-9 or low * t > size + 1e-9 or np.minimum(high, point).sum() < needed(size, max(low, size * t), t):
                continue
            if isinstance(below, tuple):
                todo += below
                continue
            bound = np.minimum(self.points[below], point).sum(axis=1)
            out.append(below[bound >= needed(size, self.sizes[below], t)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def similar(a: np.ndarray, b: np.ndarray, t: tuple[int, int]) -> bool:
    """Whether shared * t[1] >= union * t[0], in whole numbers."""
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return shared * t[1] >= (len(a) + len(b) - shared) * t[0]


def linked(sets: list[np.ndarray], t: tuple[int, int], asking: np.ndarray | None = None) -> np.ndarray:
    """For each set, the number of the first set of its component; only pairs with an asking set are looked at."""
    head = np.arange(len(sets))
    share = t[0] / t[1]
    sizes = np.array([len(s) for s in sets])
    points = np.array([counts(s) for s in sets])
    # Counts in more groups, with the same bound, for the pairs that the tree lets pass.
    fine = np.array([counts(s, FINE) for s in sets], np.uint16 if sizes.max(initial=0) < 1 << 16 else np.int64)
    tree = Tree(points, sizes)
    for k in range(len(sets)) if asking is None else np.flatnonzero(asking).tolist():
        near = np.sort(tree.near(points[k], int(sizes[k]), share))
        near = near[(head[near] != head[k]) & ((near < k) | (asking is not None))]
        bound = np.minimum(fine[near], fine[k]).sum(axis=1, dtype=np.int64)
        for other in near[bound >= needed(int(sizes[k]), sizes[near], share)].tolist():
            a, b = head[k], head[other]
            if a != b and similar(sets[k], sets[other], t):
                head[head == max(a, b)] = min(a, b)
    return head


def _named(sets: list[np.ndarray], names: Names) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """The name of each set, a signed number that equal sets share and others do not, 0 for the empty set; a second and independent number;
    and the mixed shingles that the name is made from."""
    sizes = np.array([len(s) for s in sets], np.int64)
    all_ = np.concatenate([np.zeros(0, np.uint64), *sets])
    mixed = mix(all_ * _STEP)
    ends = np.cumsum(sizes)
    filled = sizes > 0
    totals = np.zeros((2, len(sets)), np.uint64)
    if len(all_):
        first = (ends - sizes)[filled]
        totals[0, filled] = np.add.reduceat(mixed, first)
        totals[1, filled] = np.bitwise_xor.reduceat(mix(all_ + _STEP), first)
    found = np.where(filled, mix(totals[0] + sizes.astype(np.uint64)) >> np.uint64(64 - names.bits), np.uint64(0)).view(np.int64)
    checks = mix(totals[1] + sizes.astype(np.uint64)).view(np.int64)
    found = np.where(filled & (found == 0), 1, found).tolist()
    if names.shared:
        found = [names.others.get((n, c), n) if n in names.shared else n for n, c in zip(found, checks.tolist(), strict=True)]
    return found, checks, np.split(mixed, ends[:-1]) if len(sets) else []


def _counts(sets: list[np.ndarray]) -> np.ndarray:
    """``counts`` of several sets; the largest of 16 bits stands for all from there on, see Tree."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    group = (np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(7)).astype(np.int64) & (DIMENSIONS - 1)
    made = np.bincount(row * DIMENSIONS + group, minlength=len(sets) * DIMENSIONS)
    return np.minimum(made, 65535).astype(np.uint16).reshape(len(sets), DIMENSIONS)


class Names:
    """How sets are named: by ``bits`` of a hash, and by another one for sets that would share a name by chance.

    Names that several sets have are found by a second hash over all documents; at 64 bits these are about
    n * n / 2**65 of n sets (three of ten billion), so they fit in every task.
    """

    def __init__(self, bits: int, others: dict[tuple[int, int], int] | None = None):
        self.bits, self.others = bits, others or {}
        self.shared = {name for name, _ in self.others}


def _names(source: DataFrame, size: int, t: float, bits: int) -> tuple[DataFrame, Names]:
    """The sets of all rows and the blocks of their parts, written, and how sets are named."""
    names = Names(bits)
    rows = written(source.mapInArrow(_sets(size, t, names), SETS), "sets")
    sets = rows.where("route IS NULL")
    both = sets.groupBy("name").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("name")
    others = {(r.name, r.check): r.other for r in sets.join(both, "name").select("name", "check", F.xxhash64("name", "check").alias("other")).distinct().collect()}
    if others:
        names = Names(bits, others)
        rows = written(source.mapInArrow(_sets(size, t, names), SETS), "sets")
    return rows, names


# Rows of sets, and those of blocks, which have a route. A number is that of one of the rows with a name, as a task meets it first, or of the block's first set.
SETS = "doc_id long, id long, version long, n_shingles long, name long, check long, counts binary, number long, route int, block binary"


def _sets(size: int, t: float, names: Names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        seen: set[int] = set()
        for piece in pieces(batches):
            own = shingle_sets(piece, size)
            named, checks, mixed = _named(own, names)
            numbers: list[int | None] = []
            for name, one, its in zip(named, own, mixed, strict=True):
                new = name and name not in seen
                if new:
                    seen.add(name)
                    if blocks.full():
                        yield _set_rows(blocks.rows())
                numbers.append(blocks.add(signatures(one, t, its)) if new else None)
            yield _set_rows(
                {
                    **{c: piece.batch.column(c) for c in ("doc_id", "id", "version")},
                    "n_shingles": pa.array([len(s) for s in own], pa.int64()),
                    "name": pa.array(named, pa.int64()),
                    "check": pa.array(checks),
                    "counts": pa.array([row.tobytes() for row in _counts(own)], pa.binary()),
                    "number": pa.array(numbers, pa.int64()),
                }
            )
        yield _set_rows(blocks.rows())

    return run


_SET_TYPES = {**dict.fromkeys(["doc_id", "id", "version", "n_shingles", "name", "check"], pa.int64()), "counts": pa.binary(), "number": pa.int64(), "route": pa.int32(), "block": pa.binary()}


def _set_rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The given columns; the others are null."""
    rows = len(columns["number"])
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, kind)) for c, kind in _SET_TYPES.items()], list(_SET_TYPES))


class _Blocks:
    """The parts of a task's sets until they are made blocks of."""

    def __init__(self) -> None:
        self.first = TaskContext.get().partitionId() << 40  # numbers of other tasks are others
        self.parts: list[np.ndarray] = []
        self.held = 0

    def full(self) -> bool:
        return self.held >= BLOCK_PARTS or len(self.parts) == BLOCK_SETS

    def add(self, parts: np.ndarray) -> int:
        """The number of a set."""
        self.parts.append(parts)
        self.held += len(parts)
        return self.first + len(self.parts) - 1

    def rows(self) -> dict[str, pa.Array]:
        own = np.concatenate([np.zeros(0, np.uint64), *self.parts])
        of = np.repeat(np.arange(len(self.parts)), [len(p) for p in self.parts]).astype(np.uint16)
        order = np.argsort(own)
        own, of = own[order], of[order]
        route = (own >> np.uint64(64 - 12)).astype(np.int64)
        low = (own >> np.uint64(64 - 12 - 32)).astype(np.uint32)
        begin = np.flatnonzero(np.append(True, route[1:] != route[:-1])) if len(own) else np.zeros(0, np.int64)
        ends = np.append(begin[1:], len(own))[: len(begin)]
        made = {
            "number": pa.array(np.full(len(begin), self.first)),
            "route": pa.array(route[begin].astype(np.int32)),
            "block": pa.array([low[a:b].tobytes() + of[a:b].tobytes() for a, b in zip(begin.tolist(), ends.tolist(), strict=True)], pa.binary()),
        }
        self.first, self.parts, self.held = self.first + BLOCK_SETS, [], 0
        return made


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of blocks in order, each with the numbers of its sets. Blocks come sorted by route; those of whole routes are taken at a time."""
    held: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    size = 0
    for batch in batches:
        for route, first, block in zip(*[batch.column(c).to_pylist() for c in ("route", "number", "block")], strict=True):
            if size >= BLOCK_PARTS // 2 and route != held[-1][0]:
                yield from _ordered(held, held[0][0] << 32, (held[-1][0] + 1) << 32)
                held, size = [], 0
            n = len(block) // 6
            held.append((route, np.frombuffer(block, np.uint32, n), np.frombuffer(block, np.uint16, n, 4 * n), first))
            size += n
    if held:
        yield from _ordered(held, held[0][0] << 32, (held[-1][0] + 1) << 32)


def _ordered(blocks: list[tuple[int, np.ndarray, np.ndarray, int]], start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The parts from ``start`` to ``end`` of blocks, by halves if they are too many to sort at once; one part of any number of sets is given as it is."""
    blocks = [b for b in blocks if len(b[1])]
    if sum(len(b[1]) for b in blocks) <= BLOCK_PARTS:
        parts = np.concatenate([_NO, *[low.astype(np.int64) | route << 32 for route, low, _, _ in blocks]])
        numbers = np.concatenate([_NO, *[of + np.int64(first) for _, _, of, first in blocks]])
        order = np.lexsort((numbers, parts))
        if len(order):
            yield pa.RecordBatch.from_arrays([pa.array(parts[order]), pa.array(numbers[order])], ["part", "name"])
    elif end - start == 1:
        for _, low, of, first in blocks:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), start)), pa.array(of + np.int64(first))], ["part", "name"])
    else:
        middle = (start + end) // 2
        cuts = [int(np.searchsorted(low.astype(np.int64), middle - (route << 32))) for route, low, _, _ in blocks]
        yield from _ordered([(r, low[:k], of[:k], first) for (r, low, of, first), k in zip(blocks, cuts, strict=True)], start, middle)
        yield from _ordered([(r, low[k:], of[k:], first) for (r, low, of, first), k in zip(blocks, cuts, strict=True)], middle, end)


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _buckets(_unpacked(batches))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names that share a part, by bucket; equal groups of names have one bucket. Rows come sorted by part and name.

    A group of more than ``BUCKET`` names is not held: its names are linked to the least one instead, without a bucket.
    """
    part, low = None, None  # of a group that goes on from batch to batch as links
    parts, names = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        parts = np.concatenate([parts, batch.column("part").to_numpy()])
        names = np.concatenate([names, batch.column("name").to_numpy()])
        if low is not None:
            own = int(np.searchsorted(parts != part, True)) if parts[-1] != part else len(parts)
            yield _bucket_rows(_NO, names[:own], np.full(own, low))
            parts, names = parts[own:], names[own:]
            low = low if not len(parts) else None
        if not len(parts):
            continue
        begin = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
        yield _grouped(names[: begin[-1]], begin[:-1])
        parts, names = parts[begin[-1] :], names[begin[-1] :]
        if len(names) > BUCKET:
            part, low = parts[0], names[0]
            yield _bucket_rows(_NO, names[1:], np.full(len(names) - 1, low))
            parts, names = parts[:0], names[:0]
    yield _grouped(names, np.zeros(min(len(names), 1), np.int64))


def _grouped(names: np.ndarray, begin: np.ndarray) -> pa.RecordBatch:
    """Rows of whole groups of at least two names."""
    if not len(begin):
        return _bucket_rows(_NO, _NO, _NO)
    size = np.diff(np.append(begin, len(names)))
    bucket = mix(np.add.reduceat(mix(names.view(np.uint64)), begin)).view(np.int64)
    large = np.repeat(size > BUCKET, size)
    kept = np.repeat(size > 1, size) & ~large
    buckets, own = np.repeat(bucket, size)[kept], names[kept]
    order = np.lexsort((own, buckets))
    buckets, own = buckets[order], own[order]
    new = np.append(True, (buckets[1:] != buckets[:-1]) | (own[1:] != own[:-1]))[: len(own)]
    buckets, own = buckets[new], own[new]
    first = np.repeat(names[begin], size)
    return _bucket_rows(buckets, np.concatenate([own, names[large]]), np.concatenate([np.zeros(len(own), np.int64), first[large]]))


def _bucket_rows(bucket: np.ndarray, names: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    empty = len(names) - len(bucket)
    mask = np.arange(len(names)) >= len(bucket)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([bucket, np.zeros(empty, np.int64)]), mask=mask), pa.array(names), pa.array(low)], ["bucket", "name", "low"]
    )


_NO = np.zeros(0, np.int64)


def _near(t: float):
    """Links of names of a bucket that the bound on their counts allows, as few as keep them connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for rows in _groups(batches, "bucket", ["name", "n_shingles", "counts"]):
            # Tasks number equal sets each on their own.
            rows = [r for k, r in enumerate(rows) if not k or r[0] != rows[k - 1][0]]
            sizes = np.array([r[1] for r in rows])
            points = np.array([np.frombuffer(r[2], np.uint16) for r in rows]).astype(np.int64)
            head = np.arange(len(rows))
            tree = Tree(points, sizes)
            for k in range(1, len(rows)):
                near = tree.near(points[k], int(sizes[k]), t)
                for other in near[(near < k) & (head[near] != head[k])].tolist():
                    if head[other] != head[k]:
                        links.append((rows[k][0], rows[other][0]))
                        head[head == max(head[k], head[other])] = min(head[k], head[other])
            if len(links) > 10_000:
                yield _links(links)
                links = []
        yield _links(links)

    return run


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["a", "b"])


def _with_sets(size: int, carried: list[str], names: Names):
    """The sets of the texts that have the name asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            own = shingle_sets(piece, size)
            same = pa.array([a == b for a, b in zip(_named(own, names)[0], piece.batch.column("name").to_pylist(), strict=True)], pa.bool_())
            found = pa.array([s.tobytes() for s in own], pa.binary())
            yield pa.RecordBatch.from_arrays([*(piece.batch.column(c) for c in carried), found], [*carried, "shingles"]).filter(same)

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str, columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of each key; the rows of a key come one after another."""
    rows: list[tuple] = []
    last = None
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in (key, *columns)], strict=True):
            if rows and row[0] != last:
                yield rows
                rows = []
            last = row[0]
            rows.append(row[1:])
    if rows:
        yield rows


def _clusters(t: tuple[int, int]):
    """Links of each cluster: every set with the first one of its component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "route", ["name", "asks", "shingles"]):
            sets = [np.frombuffer(r[2], np.uint64) for r in rows]
            asks = np.array([r[1] for r in rows])
            heads = linked(sets, t, None if asks.all() else asks)
            pairs = [(rows[k][0], rows[h][0]) for k, h in enumerate(heads.tolist()) if h != k]
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)], ["a", "b"])

    return run


def _hubs(t: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, hub = (batch.column(c).to_pylist() for c in ("shingles", "hub_shingles"))
            same = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), t) for a, b in zip(own, hub, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("hub"), pa.array(same, pa.bool_())], ["name", "hub", "same"])

    return run


def _found(known: Members, also: bool = True):
    """The rows that may be members, or those that are not for sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(known.may_have(batch) == also))

    return run


def groups(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD, bits: int = 64) -> DataFrame:
    """``doc_id, id, version, n_shingles, name, set_group`` of every row: the id without nulls, a hash of the text, the name of its set,
    and a number that is equal for connected sets; null for the empty set."""
    exact, t = (percent, 100), percent / 100
    keys = keyed(docs, doc_id, text).withColumnRenamed("doc", "id")
    made, names = _names(keys, size, t, bits)
    rows, source = made.where("route IS NULL").drop("check", "route", "block"), keys.select("id", "version", "text")
    blocks = made.where("route IS NOT NULL").select("route", "number", "block")
    shared = written(blocks.repartition("route").sortWithinPartitions("route").mapInArrow(_bucketed, "bucket long, name long, low long"), "buckets").withColumnRenamed("name", "number")
    points = rows.where("number IS NOT NULL").select("number", "name", "n_shingles", "counts")
    meeting = shared.where("bucket IS NOT NULL").select("bucket", "number").distinct().join(points, "number").drop("number")
    near = meeting.repartition("bucket").sortWithinPartitions("bucket", "name").mapInArrow(_near(t), "a long, b long")
    crowded = shared.where("bucket IS NULL AND number <> low").select("number", "low")
    crowded = crowded.join(points.select("number", F.col("name").alias("a")), "number").join(points.select(F.col("number").alias("low"), F.col("name").alias("b")), "low")
    cluster = components(near.unionByName(crowded.select("a", "b")))
    cluster = written(cluster.select(F.col("id").alias("name"), F.col("component").alias("cluster")).unionByName(cluster.select(F.col("component").alias("name"), F.col("component").alias("cluster")).distinct()), "clusters")
    size_of = cluster.groupBy("cluster").agg(F.count("*").alias("members"))
    # One text for each set.
    heads = rows.join(cluster, "name").groupBy("name", "cluster").agg(F.min(F.struct("id", "version")).alias("at"))
    heads = written(heads.join(size_of, "cluster").select("name", "cluster", "members", "at.id", "at.version"), "heads")
    some = source.mapInArrow(_found(members(heads, ["id", "version"])), source.schema)
    own = some.join(heads, ["id", "version"]).select("name", "cluster", "members", "text")
    own = written(own.mapInArrow(_with_sets(size, ["name", "cluster", "members"], names), "name long, cluster long, members long, shingles binary").dropDuplicates(["name"]), "cluster-sets")
    small = own.where(F.col("members") <= crowd).select(F.col("cluster").alias("route"), "name", F.lit(True).alias("asks"), "shingles")
    links = small.repartition("route").sortWithinPartitions("route", "name").mapInArrow(_clusters(exact), "a long, b long")
    links = components(links.unionByName(_crowded(own.where(F.col("members") > crowd), exact, crowd)))
    return rows.drop("counts", "number").join(links.withColumnRenamed("id", "name"), "name", "left").withColumn(
        "set_group", F.when(F.col("n_shingles") > 0, F.coalesce("component", "name"))
    ).drop("component")


def link(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD, bits: int = 64) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the least id reachable by links of at least ``percent`` similarity."""
    rows = groups(docs, size, percent, doc_id, text, crowd, bits)
    least = rows.where("set_group IS NOT NULL").groupBy("set_group").agg(F.min("id").alias("least"))
    out = rows.join(least, "set_group", "left").withColumn("component_id", F.coalesce("least", "id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row of each group of linked texts, the one with the least id; rows without a word all stay. All columns are kept."""
    lead = unused(docs.columns)
    id_, version = f"{lead}id", f"{lead}version"
    rows = groups(docs, size, percent, doc_id, text, crowd)
    first = rows.where("set_group IS NOT NULL").groupBy("set_group").agg(F.min(F.struct("id", "version")).alias("at"), F.count("*").alias("copies"))
    gone = rows.join(first.where("copies > 1"), "set_group").where("id <> at.id OR version <> at.version").select("id", "version").distinct()
    # Rows with one id and one text, of which one stays.
    twins = rows.where("set_group IS NOT NULL").groupBy("id", "version").count().where("count > 1").select("id", "version")
    asked = written(gone.withColumn("gone", F.lit(True)).unionByName(twins.withColumn("gone", F.lit(False))), "copies")
    known = members(asked, ["id", "version"], [id_, version])
    marked = docs.withColumns({id_: F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)), version: F.xxhash64(F.col(text).cast("string"))})
    # Only rows that may be copies meet the list of these; the others stay where they are.
    alone, some = (marked.mapInArrow(_found(known, also), marked.schema) for also in (False, True))
    empty = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    some = some.join(asked.where("gone").select(F.col("id").alias(id_), F.col("version").alias(version)), [id_, version], "left_anti")
    kept = alone.unionByName(some.where(empty)).unionByName(some.where(~empty).dropDuplicates([id_, version]))
    return kept.drop(id_, version)


def _crowded(own: DataFrame, t: tuple[int, int], crowd: int) -> DataFrame:
    """Links of clusters too large for one task: with the hub, then of those without, against blocks of all."""
    hub = own.where("name = cluster").select("cluster", F.col("name").alias("hub"), F.col("shingles").alias("hub_shingles"))
    tried = written(own.join(hub, "cluster").select("name", "hub", "shingles", "hub_shingles").mapInArrow(_hubs(t), "name long, hub long, same boolean"), "hubs")
    star = tried.where("same AND name <> hub").select(F.col("name").alias("a"), F.col("hub").alias("b"))
    apart = tried.where("NOT same").select("name", F.lit(True).alias("asks"))
    marked = own.join(apart, "name", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    # Each block of members meets each block of the ones that ask; a block has about `crowd` sets.
    blocks = F.ceil(F.col("members") / crowd).cast("int")
    block = F.pmod(F.xxhash64("name"), blocks).cast("int")
    asking = marked.where("asks").select("name", "cluster", "shingles", block.alias("asker"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    other = marked.select("name", "cluster", "asks", "shingles", block.alias("block")).join(asking.select("cluster", "asker").distinct(), "cluster")
    route = F.xxhash64("cluster", "asker", "block").alias("route")
    routed = asking.select(route, "name", F.lit(True).alias("asks"), "shingles").unionByName(
        other.where("NOT (asks AND block = asker)").select(route, "name", F.lit(False).alias("asks"), "shingles")
    )
    return star.unionByName(routed.repartition("route").sortWithinPartitions("route", "name").mapInArrow(_clusters(t), "a long, b long"))
