"""Texts of Arrow batches as byte arrays: words, and hashes of any span in constant time.

A batch is cut at document borders into pieces of about ``limit`` bytes, so that the arrays made
from a piece stay small however many rows a batch has. Null texts are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = ~_SEPARATOR  # of `[^\x20\x09-\x0D]+`

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only

_rng = np.random.default_rng(20240229)
_BASE = np.uint64(0x9E3779B97F4A7C13)  # 3 modulo 8
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
_P = np.uint64((1 << 31) - 1)  # a prime
_SHIFT = np.uint64(31)
_BASES = [int(x) for x in _rng.integers(1 << 29, int(_P), 2)]
_prime_powers = [np.ones(1, np.uint64) for _ in _BASES]
_prime_inverse = [np.ones(1, np.uint64) for _ in _BASES]


@dataclass
class Piece:
    """Some rows of a batch, the bytes of their texts, and where each text begins and ends."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[Piece]:
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column).cast(pa.string()), "")
        _, places, body = texts.buffers()
        offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(texts):
            end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            end = min(max(end, row + 1), len(texts))
            yield Piece(batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
            row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _grow(n: int) -> None:
    global _powers, _inverse
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    while len(_powers) < n:
        k = len(_powers)
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(int(_BASE), k, 1 << 64))])
        _inverse = np.concatenate([_inverse, _inverse * np.uint64(pow(int(inverse), k, 1 << 64))])


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial sums modulo 2**64, from which ``span_hash`` takes the hash of a span of a few hundred items.

    From 1,024 items on there are pairs of spans whose sums are equal whatever the base; ``long_hash`` is for these.
    """
    _grow(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _inverse[start])


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number that is equal modulo the prime: below 2**33 for any, below 2**32 for products of reduced ones."""
    return (x & _P) + (x >> _SHIFT)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(_fold(x)))
    return np.where(x >= _P, x - _P, x)


def _grow_prime(n: int) -> None:
    for own, base in enumerate(_BASES):
        for table, factor in ((_prime_powers, base), (_prime_inverse, pow(base, -1, int(_P)))):
            while len(table[own]) < n:
                step = np.uint64(pow(factor, len(table[own]), int(_P)))
                table[own] = np.concatenate([table[own], _reduced(table[own] * step)])


def long_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of bytes modulo a prime with two bases, from which ``long_hash`` takes the hash of any span."""
    values, n = _CODE[data], len(data)
    _grow_prime(n + 1)
    out = np.zeros((2, n + 1), np.uint64)
    for own, bits in enumerate((values & _P, (values >> _SHIFT) & _P)):
        np.cumsum(_fold(bits * _prime_powers[own][:n]), out=out[own, 1:])
    return out


def long_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    low, high = (_reduced(_reduced(s[end] - s[start]) * t[start]) for s, t in zip(sums, _prime_inverse, strict=True))
    return mix(low | high << np.uint64(32))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_hash(_CODE[data])


@dataclass
class Words:
    """Words of a piece: first byte, byte behind the last, and the number of the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count())


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = WORD_BYTE) -> Words:
    inside = word_byte[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = offsets[(offsets > 0) & (offsets < len(data))]
    begins[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` items that lie in one row, and their rows."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(count) - count
    return np.arange(count.sum()) - before[row] + first[:-1][row], row


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
