"""Change events of a stream or of one of its batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.columns import as_list
from chartloom.operators.nesting import last_row
from chartloom.sources.changes import POSITION, SOURCE, decode


def route(events: DataFrame, name: str, exact: bool = True) -> DataFrame:
    """Events of one source table, by its full envelope name or by a part of it."""
    source = F.col(SOURCE)
    return events.where(source == name if exact else source.contains(name))


def after_image(
    stream: DataFrame, schema: T.StructType, source: str | None = None, exact: bool = True
) -> DataFrame:
    """Rows after the change, with the position of the change.

    Deletes and text that is no envelope have no such row and are left out. The stream metric
    ``changes`` counts them.
    """
    events = decode(stream, schema)
    if source is not None:
        events = route(events, source, exact)
    missing = F.col("after").isNull()
    if events.isStreaming:
        events = events.observe(
            "changes",
            F.count(F.lit(1)).alias("seen"),
            F.count_if(missing).alias("skipped"),
        )
    return events.where(~missing).select("after.*", POSITION)


def last_changes(batch: DataFrame, keys: str | Sequence[str], with_position: bool = False) -> DataFrame:
    """The last change of every key; changes at one position are told apart by their values."""
    names = as_list(keys)
    rest = sorted(c for c in batch.columns if c not in (*names, POSITION))
    last = last_row(batch, names, [POSITION, *rest])
    return last if with_position else last.drop(POSITION)


def batch_keys(
    batch: DataFrame, columns: Mapping[str, str] | Sequence[str], null_as: int | None = None, distinct: bool = True
) -> dict[str, DataFrame]:
    """Distinct keys a batch touches: a frame for every entity, with NULL replaced if asked.

    ``columns`` maps the key column of an entity to the column of the batch. ``key_sets`` needs no distinct keys.
    """
    pairs = columns if isinstance(columns, Mapping) else {c: c for c in columns}

    def keys(entity: str, column: str) -> DataFrame:
        value = F.col(column) if null_as is None else F.coalesce(column, F.lit(null_as))
        found = batch.select(value.alias(entity))
        return found.distinct() if distinct else found

    return {entity: keys(entity, column) for entity, column in pairs.items()}
