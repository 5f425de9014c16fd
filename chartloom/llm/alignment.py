"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and counts of overlapping token pairs.

``A`` is a byte-level BPE of the tokenizers library, read with a space before the text; ``B`` is a sentencepiece model,
which adds that space itself. Tokens are nodes; every token points to its farthest-right overlapping token, which is
itself for a token of A that ends where a token of B does. Squaring the pointers (successor of successor) until they
rest leads every token to the last token of its component, which labels the group. All documents of a block of about
``BLOCK_BYTES`` are done at once in arrays.

Both tokenizers split at white space, so words are encoded once for each worker and looked up afterwards, if the
vocabulary of B has no piece that goes on behind a word (``_Pair.safe``); otherwise whole texts are encoded.

Counts: each block has its distinct pairs once; these are summed over all blocks, joined back to the blocks, and read by
the documents of each block, which hold numbers of pairs only.

A null or empty text, or one whose tokens do not spell a space and the text, has no tokens: zeros, and no groups. Repeated
rows are counted as often as they are there. An empty table gives no rows; other columns are not read. A text must fit in
a task's memory some forty times over, as it is never split.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.bpe import _Shared
from chartloom.llm.rows import texts
from chartloom.session import written

BLOCK_BYTES = 4 << 20
TABLE = 200_000  # words a worker remembers; a full table is emptied, which costs time only
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # White_Space of Unicode
_WORDS = re.compile(rf"(?<=[^{_SPACE}])(?=[ \n])")
_UNIT = b"".join

_BLOCK = "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, counts array<long>, uses binary"
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _byte_of() -> dict[str, int]:
    """Bytes by the characters that byte-level vocabularies write for them: printable ones stand for themselves, the others
    for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


def _by_rank(a: bytes, byte: dict[str, int], pattern: str):
    """The merges of A for each match of the pattern by tiktoken, if its ids are in the order of merges (of equal results, faster)."""
    from tiktoken import Encoding

    model = json.loads(a)["model"]
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:], strict=False)):
        return None
    made = {k for k in merged} | {model["vocab"][c] for c in byte}
    ranks = {bytes(byte[c] for c in entry): k for entry, k in model["vocab"].items() if k in made}
    return Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class _Pair:
    """Both tokenizers of a worker, the bytes of their tokens, and the words seen lately."""

    def __init__(self, a: bytes, b: bytes, pattern: str | None = None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a.decode()), SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        byte = _byte_of()
        entries = self.a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, k in entries.items():
            self.bytes_a[k] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        plain = [p.replace("▁", " ") for k, p in enumerate(names) if not self.b.is_byte(k) and not self.b.is_control(k) and not self.b.is_unknown(k)]
        # Words can be encoded one by one if no piece joins a word with what follows it, and line ends are bytes of their own.
        self.safe = not any(_WORDS.search(p) or "\n" in p for p in plain)
        self.lone = self.b.piece_to_id("▁")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int32) for t in (self.bytes_a, self.bytes_b))
        ids = [str(k) for k in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.marks = pa.array([k + end for k in ids for end in (",", "|", ";", "")], pa.string())
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.core = _by_rank(a, byte, pattern) if pattern else None

    def learn(self, words: set[str]) -> None:
        """Look up words (stretches of text that a space begins or a line end): ids of both, and whether they spell it."""
        new = [w for w in words if w not in self.known]
        of_a = [self.core.encode_ordinary(w) for w in new] if self.core else [x.ids for x in self.a.encode_batch_fast(new, add_special_tokens=False)]
        of_b = self.b.encode([w[1:] if w[0] == " " else w for w in new], num_threads=1) if new else []
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        for word, a, b in zip(new, of_a, of_b, strict=True):
            good = True
            if word[0] != " ":  # without the space that B adds
                good, b = bool(b) and b[0] == self.lone, b[1:]
            good = good and word.encode() == _UNIT([bytes_a[k] for k in a]) == _UNIT([bytes_b[k] for k in b])
            self.known[word] = array("i", a).tobytes(), array("i", b).tobytes(), good

    def texts(self, few: list[str]) -> list[tuple[bytes, bytes, int]]:
        """Ids of both tokenizers for each text, and the bytes they cover; none of them if they do not spell a space and the text."""
        if not self.safe:
            return [self.whole(t) for t in few]
        split = [_WORDS.split(" " + t) if t else [] for t in few]
        if len(self.known) > TABLE:
            self.known.clear()
        self.learn(set(chain.from_iterable(split)))
        out = []
        for text, words in zip(few, split, strict=True):
            ids = [self.known[w] for w in words]
            if all([x[2] for x in ids]):
                out.append((_UNIT([x[0] for x in ids]), _UNIT([x[1] for x in ids]), len(text.encode()) + 1 if text else 0))
            else:
                out.append(self.whole(text))
        for word in [w for w in chain.from_iterable(split) if len(w) > 64]:
            self.known.pop(word, None)
        return out

    def whole(self, text: str) -> tuple[bytes, bytes, int]:
        if not text:
            return b"", b"", 0
        a, b, body = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text), (" " + text).encode()
        if body != _UNIT([self.bytes_a[k] for k in a]) or body != _UNIT([self.bytes_b[k] for k in b]):
            return b"", b"", 0
        return array("i", a).tobytes(), array("i", b).tobytes(), len(body)


_made: dict[int, _Pair] = {}


def _tokenizers(shared: _Shared) -> _Pair:
    if shared.id not in _made:
        _made.clear()
        _made[shared.id] = _Pair(*shared.value)
    return _made[shared.id]


def resting(successor: np.ndarray) -> np.ndarray:
    """The node at which the pointers of each node end, by squaring them until nothing changes."""
    while True:
        after = successor[successor]
        if np.array_equal(after, successor):
            return successor
        successor = after


def groups(last_a: np.ndarray, last_b: np.ndarray) -> dict[str, np.ndarray]:
    """Groups and links of tokens given by their last bytes (increasing; both cover the same bytes).

    ``of_a``, ``of_b``: group of each token. ``end_a``, ``end_b``: last token of each group. ``link_a``, ``link_b``: tokens of
    all overlapping pairs, in order.
    """
    n = int(last_a[-1]) + 1 if len(last_a) else 0
    ends_a, ends_b = np.zeros(n, bool), np.zeros(n, bool)
    ends_a[last_a], ends_b[last_b] = True, True
    at_a, at_b = (np.cumsum(x, dtype=np.int32) - x for x in (ends_a, ends_b))  # the token that covers each byte
    n_a = len(last_a)
    # The farthest-right overlapping token covers the last byte: it ends there too, or reaches further.
    both = ends_b[last_a]
    successor = np.concatenate([np.where(both, np.arange(n_a, dtype=np.int32), n_a + at_b[last_a]), at_a[last_b]]).astype(np.int32)
    label = resting(successor)
    number = np.cumsum(both, dtype=np.int32) - 1
    ends = np.flatnonzero(both)
    border = np.flatnonzero(ends_a | ends_b)
    return {
        "of_a": number[label[:n_a]],
        "of_b": number[label[n_a:]],
        "end_a": ends,
        "end_b": at_b[last_a[ends]],
        "link_a": at_a[border],
        "link_b": at_b[border],
    }


def _block(pair: _Pair, block: int, ids: list, found: list[tuple[bytes, bytes, int]], digest: bool) -> dict[str, list]:
    """Rows of the documents of a block, and one of its pairs."""
    a, b = (np.frombuffer(_UNIT([f[k] for f in found]), np.int32) for k in (0, 1))
    first_a, first_b = (np.concatenate([[0], np.cumsum([len(f[k]) // 4 for f in found])]) for k in (0, 1))
    begin = np.concatenate([[0], np.cumsum([f[2] for f in found])])
    last_a, last_b = np.cumsum(pair.sizes_a[a], dtype=np.int64) - 1, np.cumsum(pair.sizes_b[b], dtype=np.int64) - 1
    g = groups(last_a, last_b)
    n_groups = np.diff(np.searchsorted(g["end_a"], first_a))
    first_link = np.searchsorted(g["link_a"], first_a)
    n_links = np.diff(first_link)

    # Texts of the groups: tokens in the order (group, side, place), each with the sign that follows it.
    before_b = np.concatenate([[0], g["end_b"] + 1])
    mark_a, mark_b = a.astype(np.int64) * 4, b.astype(np.int64) * 4
    mark_a[g["end_a"]] += 1
    mark_b[g["end_b"]] += 2
    mark_b[(first_b[1:] - 1)[np.diff(first_b) > 0]] += 1
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + before_b[g["of_a"]]] = mark_a
    order[np.arange(len(b)) + g["end_a"][g["of_b"]] + 1] = mark_b
    spelled = pair.marks.take(pa.array(order))
    _, places, body = spelled.buffers()
    cut = np.frombuffer(places, np.int32)[: len(order) + 1][first_a + first_b].tolist()
    body = memoryview(body) if body is not None else memoryview(b"")
    parts = [body[x:y] for x, y in zip(cut, cut[1:], strict=False)]
    texts_ = [(hashlib.sha256(p).hexdigest() if digest else bytes(p).decode()) if len(p) else "" for p in parts]

    # Pairs of the block, and the numbers of those that each document has.
    codes, pairs = pd.factorize(a[g["link_a"]].astype(np.int64) << 32 | b[g["link_b"]])
    n = len(ids)
    key = np.sort(np.repeat(np.arange(n), n_links) * max(len(pairs), 1) + codes)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(new, len(key)))
    key = key[new]
    uses = np.concatenate([np.diff(key, prepend=0), times]).astype(np.int64)
    return {
        "block": [block] * (n + 1),
        "place": [*range(n), -1],
        "doc_id": [*ids, None],
        "n_a": [*np.diff(first_a).tolist(), None],
        "n_b": [*np.diff(first_b).tolist(), None],
        "n_groups": [*n_groups.tolist(), None],
        "n_links": [*n_links.tolist(), None],
        "groups": [*texts_, None],
        "pairs": [None] * n + [pairs],
        "counts": [None] * n + [np.bincount(codes, minlength=len(pairs))],
        "uses": [None] * n + [zstandard.ZstdCompressor(level=1).compress(uses.tobytes())],
    }


_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("uses", pa.binary())]
)


def _blocks(shared: _Shared, block_bytes: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, ids, found, size = _tokenizers(shared), [], [], 0
        block = TaskContext.get().partitionId() << 32

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(_block(pair, block, ids, found, digest), _BLOCK_SCHEMA)

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                few = batch.slice(start, 64)
                done = pair.texts([t or "" for t in few.column("text").to_pylist()])
                for doc_id, tokens in zip(few.column("doc_id").to_pylist(), done, strict=True):
                    ids.append(doc_id)
                    found.append(tokens)
                    size += found[-1][2]
                    if size >= block_bytes or len(ids) >= 65536:
                        yield made()
                        ids, found, size, block = [], [], 0, block + 1
        if ids:
            yield made()

    return run


def _counted(rows: pa.Table, values: pa.Table) -> pa.Table:
    """Documents of a block with the counts of their links."""
    rows = rows.sort_by("place")
    docs = rows.slice(1)
    n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    if len(values):
        total, best = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
        code = values.column("code").to_numpy()
        total[code] = values.column("total").to_numpy()
        best[code] = values.column("best").to_numpy()
        uses = np.frombuffer(zstandard.ZstdDecompressor().decompress(rows.column("uses")[0].as_py()), np.int64)
        times = uses[len(uses) // 2 :]
        row, code = np.divmod(np.cumsum(uses[: len(uses) // 2]), len(values))
        np.add.at(n_best, row, times * best[code])
        np.add.at(count_sum, row, times * total[code])
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum)).append_column("groups", docs.column("groups"))


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    pattern: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row.

    ``groups`` is written as ``a1,a2|b1;a3|b2,b3``; with ``digest`` it is the SHA-256 of that. ``n_best`` is the number of links whose
    count is the highest of their B token, ``count_sum`` the sum of the counts of all links; both count over the whole frame.
    The files of both tokenizers have a fixed size and are broadcast. ``pattern`` may give the expression by which A splits texts; words
    are then merged by tiktoken with A's vocabulary, which gives the same ids in less time.
    """
    spark = docs.sparkSession
    files = []
    for path in (path_a, path_b):
        with open(path, "rb") as file:
            files.append(file.read())
    shared = _Shared(spark.sparkContext.broadcast((*files, pattern)))
    found = written(texts(docs, doc_id, text).mapInArrow(_blocks(shared, block_bytes, digest), _BLOCK), "aligned")
    own = found.where("place = -1").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "p")).select("block", "code", "p.*")
    total = written(own.groupBy("pairs").agg(F.sum("counts").alias("total")).withColumn("b", F.col("pairs").bitwiseAND((1 << 32) - 1)), "pair-counts")
    # One row for each token of B, which the vocabulary bounds.
    highest = total.groupBy("b").agg(F.max("total").alias("highest"))
    judged = total.join(F.broadcast(highest), "b").select("pairs", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    values = own.join(judged, "pairs").select(F.col("block").alias("home"), "code", "total", "best")
    rows = found.drop("pairs", "counts")
    return rows.groupBy("block").cogroup(values.groupBy("home")).applyInArrow(_counted, _OUT)
