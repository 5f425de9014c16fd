"""Byte-level BPE: encoding by longest matches with backtracking, and decoding.

Every byte is a Latin-1 character, so one pyahocorasick automaton over the vocabulary finds the
tokens at each place of a word. A sequence of tokens is the one that merging by rank would give
exactly if each adjacent pair is: the pair's bytes, merged, give the pair again. The encoder takes
the longest token at each place, goes back where the pair with the token before is not compatible,
and remembers places from which no way leads on, so a word takes time in proportion to its length.

Ids are stored as little-endian unsigned 32-bit integers. A null or empty text has no ids. Repeated
rows give repeated results; no other column is read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chartloom.llm.rows import texts

# Entries of each worker's tables of words and pairs; a full table is emptied, which costs time only.
TABLE = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


_CLASSES = {r"\p{L}": r"A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\u024F", r"\p{N}": "0-9"}
_UNUSUAL = re.compile(r"[^\t\n\r -~\xC0-\xD6\xD8-\xF6\xF8-\u024F]")


def splitter(pattern: str):
    """Function from a text to the matches of the pattern.

    Texts of printable ASCII and Latin letters only, where letters, digits and white space are short
    lists of characters, are split by the same pattern with these lists, which takes half the time.
    """
    split = regex.compile(pattern).findall
    short = re.sub(
        r"\[[^\]]*\]|\\p\{[LN]\}",
        lambda m: "".join(re.sub(r"\\p\{[LN]\}", lambda c: _CLASSES[c[0]], m[0])) if m[0][0] == "[" else f"[{_CLASSES[m[0]]}]",
        pattern,
    )
    if re.search(r"\\[pP]|\\[wWdDbB]|\(\?[^!=:<]", short):
        return split
    quick = re.compile(short).findall
    return lambda text: split(text) if _UNUSUAL.search(text) else quick(text)


class Vocabulary:
    """Tokens, the merge that made each of them, and the encoder for one word."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.codes = {rank: rank.to_bytes(4, "little") for rank in self.tokens}
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), (len(token), rank))
        self.finder.make_automaton()
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token joined; none for a single byte."""
        if token not in self.made_of:
            parts = [bytes([x]) for x in self.tokens[token]]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], 1 << 60))
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self.made_of[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.made_of[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives these two tokens again.

        The merges are undone from the latest backwards. What then touches at the border must not
        have been due for a merge before the one that was undone last; of equal ranks, the merge
        further left comes first.
        """
        key = left << 32 | right
        if len(self.pairs) >= TABLE:
            self.pairs.clear()
        a, b, due = left, right, 1 << 60
        while True:
            joined = self.ranks.get(self.tokens[a] + self.tokens[b])
            if joined is not None and joined < due:
                self.pairs[key] = False
                return False
            of_a, of_b = self.halves(a), self.halves(b)
            if of_a is None and of_b is None:
                self.pairs[key] = True
                return True
            if of_b is None or (of_a is not None and a > b):
                a, due = of_a[1], a
            else:
                b, due = of_b[0], b + 1

    def encode_word(self, word: bytes) -> list[int]:
        if (whole := self.ranks.get(word)) is not None:
            return [whole]
        n = len(word)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]  # tokens by their first byte, shortest first
        for end, found in self.finder.iter(word.decode("latin-1")):
            at[end - found[0] + 1].append(found)
        pairs, path, before, place = self.pairs, [], -1, 0
        dead: set[tuple[int, int]] = set()  # place and the token before it, from which no way leads to the end
        untried = list(at[0])
        back: list[tuple[int, int, list]] = []
        while place < n:
            while untried:
                size, rank = untried.pop()
                if dead and (place + size, rank) in dead:
                    continue
                if before >= 0:
                    fits = pairs.get(before << 32 | rank)
                    if not (self.compatible(before, rank) if fits is None else fits):
                        continue
                back.append((place, before, untried))
                path.append(rank)
                place, before = place + size, rank
                untried = list(at[place])
                break
            else:
                dead.add((place, before))
                if not path:
                    raise ValueError("a byte of the text is not in the vocabulary")
                place, before, untried = back.pop()
                path.pop()
        return path

    def encode(self, words: list[str]) -> bytes:
        """Ids of a text's words, of which few are seen for the first time."""
        table = self.words
        try:
            return b"".join([table[w] for w in words])
        except KeyError:
            if len(table) + len(words) > TABLE:
                table.clear()
            out, code = [], self.codes
            for word in words:
                ids = table.get(word)
                if ids is None:
                    if len(table) >= TABLE:
                        table.clear()
                    ids = b"".join([code[i] for i in self.encode_word(word.encode())])
                    if len(word) <= 64:
                        table[word] = ids
                out.append(ids)
            return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_made: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """The vocabulary of a broadcast, built once per worker."""
    if shared.id not in _made:
        _made.clear()
        _made[shared.id] = Vocabulary(shared.value)
    return _made[shared.id]


class Tokenizer:
    """Encoding and decoding of frames by a vocabulary file, which has a fixed size and is broadcast."""

    def __init__(self, spark, path: str, pattern: str):
        self.shared = _Shared(spark.sparkContext.broadcast(load_ranks(path)))
        self.pattern = pattern

    def encode(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``doc_id, n_tokens, ids``: whole texts, each match of the pattern on its own, without special tokens."""
        shared, pattern = self.shared, self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, split = _vocabulary(shared), splitter(pattern)
            for batch in _small(batches):
                found = [vocabulary.encode(split(t or "")) for t in batch.column("text").to_pylist()]
                sizes = pa.array([len(x) // 4 for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(found, pa.binary())], ["doc_id", "n_tokens", "ids"])

        return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids binary")

    def round_trip(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``encode`` and ``decode`` by one worker for each task, which holds one vocabulary instead of two."""
        shared, pattern = self.shared, self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, split = _vocabulary(shared), splitter(pattern)
            for batch in _small(batches):
                found = [vocabulary.encode(split(t or "")) for t in batch.column("text").to_pylist()]
                sizes = pa.array([len(x) // 4 for x in found], pa.int64())
                decoded = pa.array([vocabulary.decode(x) for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(found, pa.binary()), decoded], ["doc_id", "n_tokens", "ids", "decoded"])

        return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """The frame of ``encode`` with the bytes of the tokens in ``decoded``."""
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = _vocabulary(shared)
            for batch in _small(batches):
                decoded = pa.array([vocabulary.decode(x or b"") for x in batch.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

        return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


class _Shared:
    """A broadcast with an id that workers can know it by."""

    def __init__(self, broadcast):
        self.broadcast = broadcast
        self.id = broadcast._jbroadcast.id() if broadcast._jbroadcast is not None else 0

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
