"""Projections, filters, lookups and key-set joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.columns import as_list, is_atomic, row_bytes
from chartloom.session import remove, settled

# A frame is broadcast only when a count of its bytes stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key that at least this share of the rows has is joined by itself.
HOT_SHARE = 0.01


# -- projections ------------------------------------------------------------------------------


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select the columns of ``{old: new}`` under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def replace_columns(df: DataFrame, expressions: dict[str, Column]) -> DataFrame:
    """Replace columns by expressions over the old ones, all in one projection."""
    return df.withColumns(expressions)


def rename_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are ignored."""
    return df.withColumnsRenamed(names)


def tag(df: DataFrame, doc_type: str) -> DataFrame:
    return df.withColumn("type", F.lit(doc_type))


def ensure_build_date(df: DataFrame, built_at: Column | None = None) -> DataFrame:
    """Add ``build_date`` unless the frame has one."""
    if "build_date" in df.columns:
        return df
    return df.withColumn("build_date", F.current_timestamp() if built_at is None else built_at)


def fill_strings(df: DataFrame) -> DataFrame:
    """NULL to empty text in text columns; other columns keep their NULLs."""
    return df.na.fill("")


# -- filters ----------------------------------------------------------------------------------


def _is_flag(df: DataFrame, column: str, value: bool) -> Column:
    """Comparison with a boolean or 0/1 flag, in the form a scan can evaluate."""
    boolean = isinstance(df.schema[column].dataType, T.BooleanType)
    return F.col(column) == F.lit(value if boolean else int(value))


def not_voided(df: DataFrame, column: str = "voided", null_is_live: bool = True) -> DataFrame:
    """Rows whose flag is off; a missing flag counts as off unless told otherwise."""
    off = _is_flag(df, column, False)
    return df.where(F.col(column).isNull() | off if null_is_live else off)


def not_retired(df: DataFrame, column: str = "retired", null_is_live: bool = True) -> DataFrame:
    return not_voided(df, column, null_is_live)


def preferred(df: DataFrame, column: str = "preferred") -> DataFrame:
    return df.where(_is_flag(df, column, True))


# -- size check -------------------------------------------------------------------------------


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a frame: one distributed sum, one number back."""
    total = df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


class Dimension(NamedTuple):
    """A frame to look values up in, and whether it was measured to be small."""

    rows: DataFrame
    small: bool


def measured(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> Dimension:
    return Dimension(df, fits_broadcast(df, max_bytes))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a frame for broadcast after measuring it; a larger one is left to a shuffled join."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


# -- joins ------------------------------------------------------------------------------------


def _pairs(on: str | Sequence) -> list[tuple[str, str]]:
    keys = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]


def lookup(
    df: DataFrame,
    dim: DataFrame | Dimension,
    on: str | Sequence,
    how: str = "inner",
    prefix: str = "",
    spread_nulls: bool = False,
) -> DataFrame:
    """Attach the columns of ``dim`` by equal keys.

    ``on`` is a column name, a list of names, or a list of ``(left, right)`` pairs. The key
    columns of ``dim`` are not kept; its other columns get ``prefix``, so that one dictionary can
    be joined in several roles. Spark broadcasts a ``dim`` whose files are small by itself; a
    derived one is passed as ``measured(dim)``. ``spread_nulls`` keeps left rows without a key, often most of
    them, from meeting in one task when the dictionary is too large to broadcast.
    """
    dim, small = dim if isinstance(dim, Dimension) else (dim, False)
    pairs = _pairs(on)
    rights = {r for _, r in pairs}
    renamed = dim.select(
        *[F.col(r).alias(f"__key_{i}") for i, (_, r) in enumerate(pairs)],
        *[F.col(c).alias(f"{prefix}{c}") for c in dim.columns if c not in rights],
    )
    if small:
        renamed = F.broadcast(renamed)
    condition = [F.col(left) == F.col(f"__key_{i}") for i, (left, _) in enumerate(pairs)]
    helpers = [f"__key_{i}" for i in range(len(pairs))]
    if spread_nulls and how == "left" and not small:
        stable = [F.col(f.name) for f in df.schema.fields if is_atomic(f.dataType)]
        no_key = F.col(pairs[0][0]).isNull()
        df = df.withColumn(
            "__bucket",
            F.when(no_key, F.xxhash64(*stable)).otherwise(F.lit(0)),
        )
        renamed = renamed.withColumn("__key_bucket", F.lit(0).cast("bigint"))
        condition.append(F.col("__bucket") == F.col("__key_bucket"))
        helpers += ["__bucket", "__key_bucket"]
    return df.join(renamed, condition, how).drop(*helpers)


def lookups(
    df: DataFrame, roles: Sequence[tuple[Dimension, str | Sequence, dict]], deal: Callable[[DataFrame, bool], DataFrame] | None = None
) -> DataFrame:
    """Several lookups, each a measured dictionary, its keys and the options of ``lookup``, that do not use each other's columns.

    Large dictionaries come first, since their joins move the rows. Then the rows, still without the texts of small
    dictionaries, are dealt for what comes next, by a function that is told whether a join has moved them; small
    dictionaries leave them where they are. Rows that are to be dealt are written after each join that moves them, which frees the
    files of that move; if so, the function uses them up.
    """
    folder = None
    for dim, on, options in roles:
        if not dim.small:
            df = lookup(df, dim, on, **options)
            if deal:
                before = folder
                df, folder = settled(df.sparkSession, "looked-up", lambda df=df: df)
                if before:
                    remove(df.sparkSession, before)
    df = deal(df, folder is not None) if deal else df
    if folder:
        remove(df.sparkSession, folder)
    for dim, on, options in roles:
        if dim.small:
            df = lookup(df, dim, on, **options)
    return df


def frequent_keys(df: DataFrame, column: str, share: float = HOT_SHARE) -> list:
    """Values that at least a share of the rows have: a frequency sketch of at most ``1 / share`` values, in one pass.

    No such value is missing; rarer ones may be among them.
    """
    found = df.where(F.col(column).isNotNull()).select(F.col(column).alias("key")).freqItems(["key"], share).first()
    return list(found[0])


def lookup_hot(df: DataFrame, dim: DataFrame, on: str | tuple[str, str], how: str = "inner", share: float = HOT_SHARE) -> DataFrame:
    """``lookup`` of a large dictionary by a key that few values, or none, make up for much of.

    Rows without a key do not meet the dictionary at all. Rows of frequent keys stay where they are: the dictionary's rows for these
    keys, at most ``1 / share`` if it is unique by key, are broadcast once their bytes are measured. The rest is joined by a shuffle, in which no
    key holds more than ``share`` of the rows.
    """
    left, right = _pairs(on if isinstance(on, str) else [on])[0]
    hot = frequent_keys(df, left, share)
    some = dim.where(F.col(right).isin(hot))
    parts = [lookup(df.where(F.col(left).isin(hot)), measured(some), [(left, right)], how)] if hot else []
    cold = df.where(F.col(left).isNotNull() & ~F.col(left).isin(hot)) if hot else df.where(F.col(left).isNotNull())
    parts.append(lookup(cold, dim.where(~F.col(right).isin(hot)) if hot else dim, [(left, right)], how))
    result = reduce(DataFrame.unionByName, parts)
    if how == "left":
        names = [f for f in result.schema.fields if f.name not in df.columns]
        result = result.unionByName(df.where(F.col(left).isNull()).withColumns({f.name: F.lit(None).cast(f.dataType) for f in names}))
    return result


def attach_children(
    df: DataFrame, id_column: str, parent_column: str, prefix: str = "child_", how: str = "inner"
) -> DataFrame:
    """Self join of parent rows with the rows that name them as parent."""
    children = df.where(F.col(parent_column).isNotNull()).select(
        *[F.col(c).alias(f"{prefix}{c}") for c in df.columns]
    )
    parents = df.where(F.col(parent_column).isNull())
    return parents.join(children, F.col(id_column) == F.col(f"{prefix}{parent_column}"), how)


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str], measure: bool = False) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    names = as_list(on)
    keys = keys.select(*names)
    return df.join(broadcast_if_small(keys.distinct()) if measure else keys, names, "left_semi")


def missing_from(df: DataFrame, other: DataFrame, on: str | Sequence[str], measure: bool = False) -> DataFrame:
    """Rows whose key does not occur in ``other``; rows without a key are missing too."""
    names = as_list(on)
    other = other.select(*names)
    return df.join(broadcast_if_small(other.distinct()) if measure else other, names, "left_anti")


def rows_of_entities_seen_at(df: DataFrame, entity: str, seen: Column) -> DataFrame:
    """All rows of the entities that have at least one row where ``seen`` holds."""
    return restrict_to(df, df.where(seen).select(entity).distinct(), entity)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing from one frame is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
