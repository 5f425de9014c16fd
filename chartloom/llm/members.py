"""Whether rows may be in a list of keys: a Bloom filter, so that only rows which may be need to meet the list.

A filter has 16 bits a key up to ``BITS`` in all, which bounds what a worker holds; with more keys more rows pass that are not
in the list. It never misses one that is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from chartloom.llm.texts import mix

BITS = 1 << 28
PER_KEY = 16
SEGMENT = 1 << 16
PROBES = 4


@dataclass
class Members:
    """The filter, and the columns of a row that make its key."""

    bits: Broadcast
    columns: tuple[str, ...]

    def may_have(self, batch: pa.RecordBatch) -> np.ndarray:
        table = np.frombuffer(self.bits.value, np.uint8)
        places = _places(_keys(batch, self.columns), 8 * len(table))
        return np.all(table[places >> 3] >> (places & 7).astype(np.uint8) & 1, axis=0)


def _keys(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """A hash of the columns, which are whole numbers and never null."""
    out = np.zeros(batch.num_rows, np.uint64)
    for c in columns:
        out = mix(out + np.uint64(0x9E3779B97F4A7C15) + batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64))
    return out


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, one row a probe; ``bits`` is a power of two."""
    step = mix(keys) | np.uint64(1)
    return np.stack([(keys + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(PROBES)]).astype(np.int64)


def members(listed: DataFrame, columns: Sequence[str], names: Sequence[str] = ()) -> Members:
    """A filter of a written list of keys. ``names`` are those of its columns in the rows that are asked about."""
    n = listed.count()
    bits = min(BITS, max(SEGMENT, 1 << (n * PER_KEY).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(_keys(batch, columns), bits))
            yield pa.RecordBatch.from_arrays([pa.array(places // SEGMENT), pa.array((places % SEGMENT).astype(np.int32))], ["segment", "place"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, place_ = batch.column("segment").to_numpy(), batch.column("place").to_numpy()
            for own in np.unique(segment).tolist():
                np.put(made.setdefault(own, np.zeros(SEGMENT, bool)), place_[segment == own], True)
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in made.values()], pa.binary())], ["segment", "bits"])

    # At most BITS / 8 bytes, whatever the list.
    found = listed.select(*columns).mapInArrow(place, "segment long, place int").repartition("segment").mapInArrow(fill, "segment long, bits binary").collect()
    table = bytearray(bits // 8)
    for row in found:
        table[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = row.bits
    return Members(listed.sparkSession.sparkContext.broadcast(bytes(table)), tuple(names or columns))
