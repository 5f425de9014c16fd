"""Folding rows into one row per key: representatives and nested arrays.

A group may hold a large part of the table. Representatives are plain aggregates that shrink on
the map side. Arrays grow with the group, so each array is dealt over rows by one rule for groups of
any size: the element of rank r (from 0) in the declared order is in part ``r div part_rows``. Part 0
always exists and carries the representatives, which further parts repeat. Nothing is dropped. A group of up to
``TASK_ROWS`` rows is folded by one task, which cuts its arrays into parts: one shuffle. Ranks of larger groups
come from prefix sums of the counts of ranges of their order, whose borders are sampled from the group itself, so no task holds
such a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column, as_list, fields_struct
from chartloom.session import bucketed, written

PART_ROWS = 10_000
# A group of this many rows, or of one part if that is more, is still folded by one task.
TASK_ROWS = 10_000
# A large array is ranked by at most this many tasks.
RANGES = 256
WHOLE = {"whole": True}
DEALT = {"dealt": True}


def is_whole(df: DataFrame) -> bool:
    """Whether all rows of a frame are known to be main rows."""
    return df.schema["part"].metadata == WHOLE


def dealt(df: DataFrame, keys: str | Sequence[str], anew: bool = False) -> DataFrame:
    """Rows dealt over tasks by their keys, once unless ``anew``: the metadata of a single key column tells that they are.

    Rows are best dealt before lookups in small dictionaries widen them, which leave them where they are. Should they have been
    dealt anew since, an aggregation by the key is as right, but moves them again. Rows that were moved before are dealt by a written
    table (``bucketed``): the files of all their moves would else be on disk together.
    """
    names = as_list(keys)
    if len(names) > 1:
        return df.repartition(*names)
    if df.schema[names[0]].metadata == DEALT and not anew:
        return df
    return marked_dealt(bucketed(df, names[0], "dealt") if anew else df.repartition(*names), names[0])


def marked_dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows that are known to be dealt by a key, as by a join on it."""
    return df.withMetadata(key, DEALT)


@dataclass(frozen=True)
class Nested:
    """An array to build: its element, which rows count, and how it is ordered.

    A ``distinct`` array keeps each element once. Any other keeps all copies, ordered by
    ``order_by`` and then by the element.
    """

    name: str
    element: Column
    when: Column | None = None
    distinct: bool = True
    order_by: tuple[ColumnOrName, ...] = ()

    def entry(self) -> Column:
        """What is collected: the element, behind its sort key if it has one."""
        if self.order_by:
            order = F.struct(*[as_column(c).alias(f"o{i}") for i, c in enumerate(self.order_by)])
            value = F.struct(order.alias("o"), self.element.alias("e"))
        else:
            value = F.struct(self.element.alias("e"))
        return value if self.when is None else F.when(self.when, value)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def pick_first(
    fields: dict[str, ColumnOrName] | Sequence[str], order_by: Sequence[ColumnOrName]
) -> Column:
    """Aggregate: the given columns of the row that comes first in ``order_by``, as a struct."""
    order = F.struct(*[as_column(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    return F.min_by(fields_struct(fields), order)


def first_row(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[ColumnOrName]) -> DataFrame:
    """The whole first row of every key."""
    names = as_list(keys)
    rest = [c for c in df.columns if c not in names]
    return df.groupBy(*names).agg(pick_first(rest, order_by).alias("__row")).select(*names, "__row.*")


def last_row(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[ColumnOrName]) -> DataFrame:
    """The whole last row of every key."""
    names = as_list(keys)
    rest = [c for c in df.columns if c not in names]
    order = F.struct(*[as_column(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    last = F.max_by(fields_struct(rest), order).alias("__row")
    return df.groupBy(*names).agg(last).select(*names, "__row.*")


def one_per_day(
    df: DataFrame,
    ts: str,
    fields: Sequence[str],
    by: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    day_name: str = "day",
) -> DataFrame:
    """The first row of every calendar day, within the columns ``by``."""
    first = pick_first([ts, *[f for f in fields if f != ts]], [ts, *tiebreak]).alias("__row")
    return (
        df.groupBy(*by, F.to_date(ts).alias(day_name)).agg(first).select(*by, day_name, "__row.*")
    )


def _collected(nested: Nested) -> Column:
    """Aggregate for one array of a group of bounded size."""
    collect = F.collect_set if nested.distinct else F.collect_list
    return F.transform(F.sort_array(collect(nested.entry())), lambda x: x["e"]).alias(nested.name)


def with_large_groups(frames: dict[str, tuple[DataFrame, str | Sequence[str]]], part_rows: int = PART_ROWS) -> dict[str, int]:
    """The frames that may have a group of more than ``part_rows`` rows, and the rows of their largest: one job over the key columns of all.

    Keys are counted by their hash, which can only make a group look larger.
    """
    rows = [df.select(F.lit(name).alias("frame"), F.xxhash64(*as_list(keys)).alias("key")) for name, (df, keys) in frames.items()]
    counts = reduce(DataFrame.unionByName, rows).groupBy("frame", "key").agg(F.count(F.lit(1)).alias("n"))
    most = counts.where(F.col("n") > part_rows).groupBy("frame").agg(F.max("n").alias("n"))
    return {r.frame: r.n for r in most.collect()}


def _task_rows(part_rows: int) -> int:
    return max(part_rows, TASK_ROWS)


def fits_task(rows: int, part_rows: int = PART_ROWS) -> bool:
    """Whether one task folds a group of so many rows."""
    return rows <= _task_rows(part_rows)


def _crowded(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > rows).select(*keys)


def in_parts(whole: DataFrame, keys: list[str], arrays: list[str], part_rows: int) -> DataFrame:
    """Whole groups, each cut into the parts of its longest array; a shorter array is empty in the last ones."""
    others = [c for c in whole.columns if c not in (*keys, *arrays, "part")]
    last = F.greatest(F.lit(1), *[F.ceil(F.size(a) / part_rows) for a in arrays]).cast("int") - 1
    cut = lambda p: F.struct(p.alias("part"), *[F.slice(a, p * part_rows + 1, part_rows).alias(a) for a in arrays])
    parts = whole.select(*keys, *others, F.inline(F.transform(F.sequence(F.lit(0), last), cut)))
    return parts.select(*keys, *others, *arrays, "part")


def _same_keys(keys: list[str], left: str, right: str) -> Column:
    """Equality of all keys, NULL being a key like any other."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def _with_keys(df: DataFrame, key_rows: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi, anti or left join on all keys."""
    joined = df.alias("l").join(key_rows.alias("r"), _same_keys(keys, "l", "r"), how)
    if how in ("left_semi", "left_anti"):
        return joined
    extra = [F.col(f"r.{c}") for c in key_rows.columns if c not in keys]
    return joined.select("l.*", *extra)


def _counted(df: DataFrame, keys: list[str], nested: Nested) -> DataFrame:
    """Distinct array entries of every key and how often each is kept; copies are counted before they move."""
    entries = df.select(*keys, nested.entry().alias("__entry")).where(F.col("__entry").isNotNull())
    if nested.distinct:
        return entries.distinct().withColumn("__copies", F.lit(1).cast("bigint"))
    return entries.groupBy(*keys, "__entry").agg(F.count(F.lit(1)).alias("__copies"))


def _borders(piles: DataFrame, keys: list[str], part_rows: int) -> DataFrame:
    """Up to ``RANGES`` entries of every large array, in order, that cut it into ranges of similar numbers of entries.

    They are sampled by the hash of the entry, so the sample is the same whenever it is taken, and follows the entries as they are:
    however alike they begin, as on one day, they are spread.
    """
    drawn = piles.where(F.pmod(F.xxhash64("__entry"), F.lit(max(part_rows // 8, 1))) == 0)
    found = drawn.groupBy(*keys).agg(F.sort_array(F.collect_set("__entry")).alias("__all"))
    step = F.ceil(F.size("__all") / RANGES)
    return found.select(*keys, F.filter("__all", lambda x, i: i % step == 0).alias("__borders"))


def _large_arrays(
    df: DataFrame, keys: list[str], arrays: Sequence[Nested], most: int
) -> DataFrame | None:
    """Keys, array numbers and sizes of the arrays above ``most`` elements; None without any.

    Many rows need not make a large array: copies may collapse, elements may be left out. The
    keys and sizes are written down, since several joins use them.
    """
    crowded = written(_crowded(df, keys, most), "crowded-keys")
    if is_empty(crowded):
        return None
    rows = _with_keys(df, crowded, keys, "left_semi")
    sizes = [
        _counted(rows, keys, a)
        .groupBy(*keys)
        .agg(F.sum("__copies").alias("__size"))
        .withColumn("__array", F.lit(i))
        for i, a in enumerate(arrays)
    ]
    large = written(reduce(DataFrame.unionByName, sizes).where(F.col("__size") > most), "array-sizes")
    return None if is_empty(large) else large


def _array_parts(df: DataFrame, keys: list[str], nested: Nested, part_rows: int) -> DataFrame:
    """One array of large groups by part: elements are ranked by the counts of earlier ranges and within their range."""
    piles = _counted(df, keys, nested)
    borders = written(_borders(piles, keys, _task_rows(part_rows)), "borders")
    below = F.size(F.filter(F.coalesce("__borders", F.array()), lambda b: b <= F.col("__entry")))
    piles = _with_keys(piles, borders, keys, "left").withColumn("__range", below).drop("__borders")
    by_range = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = piles.groupBy(*keys, "__range").agg(F.sum("__copies").alias("__n"))
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(by_range), F.lit(0))).drop("__n")
    placed = _with_keys(piles, counts, [*keys, "__range"], "left")
    within = Window.partitionBy(*keys, "__range").orderBy("__entry").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("__before") + F.coalesce(F.sum("__copies").over(within), F.lit(0))
    first, last = F.expr(f"__rank div {part_rows}"), F.expr(f"(__rank + __copies - 1) div {part_rows}")
    dealt = placed.withColumn("__rank", rank).withColumn("part", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("__rank"), F.col("part") * part_rows)
    end = F.least(F.col("__rank") + F.col("__copies"), (F.col("part") + 1) * part_rows)
    piece = F.sort_array(F.collect_list(F.struct("__entry", (end - begin).cast("int").alias("n"))))
    flat = F.flatten(F.transform(piece, lambda x: F.array_repeat(x["__entry"]["e"], x["n"])))
    return dealt.groupBy(*keys, F.col("part").cast("int").alias("part")).agg(flat.alias(nested.name))


def nest(
    df: DataFrame,
    keys: str | Sequence[str],
    arrays: Sequence[Nested],
    firsts: dict[str, ColumnOrName] | None = None,
    order_by: Sequence[ColumnOrName] = (),
    part_rows: int = PART_ROWS,
    large: bool | int | None = None,
) -> DataFrame:
    """One row per key with its nested arrays and the columns ``firsts`` of its first row.

    The result has a column ``part``: the element of rank r of an array is in part ``r div part_rows``, so
    small groups are one row. Whether there are large ones is asked of the key columns before the plan is
    made, so that the usual plan stays a single aggregation; the rows that come out are the same.
    A result of main rows only says so in the metadata of ``part`` (``is_whole``).
    ``large`` is the answer where it is known, as for several frames at once from ``with_large_groups``: none, the rows
    of the largest group, or True for groups of unknown size. Rows that are already dealt by key (``dealt``) stay where they are.
    """
    names = as_list(keys)
    first_cols = [pick_first(firsts, order_by).alias("__first")] if firsts else []
    head_cols = ["__first.*"] if firsts else []
    array_names = [a.name for a in arrays]

    def whole(rows: DataFrame) -> DataFrame:
        return (
            rows.groupBy(*names)
            .agg(*first_cols, *[_collected(a) for a in arrays])
            .select(*names, *head_cols, *array_names, F.lit(0).alias("part", metadata=WHOLE))
        )

    if large is None:
        large = with_large_groups({"rows": (df, names)}, part_rows).get("rows", 0)
    most = _task_rows(part_rows)
    # Groups are small, and scattered over the input: arrays begun before the shuffle would
    # mostly hold one element, so rows are moved as they are.
    if not large:
        return whole(dealt(df, names))
    if large is not True and fits_task(large, part_rows):
        return in_parts(whole(dealt(df, names)), names, array_names, part_rows)
    sizes = _large_arrays(df, names, arrays, most)
    if sizes is None:
        return in_parts(whole(df), names, array_names, part_rows)

    wide = sizes.select(*names).distinct()
    usual = in_parts(whole(_with_keys(df, wide, names, "left_anti")), names, array_names, part_rows)
    rows = _with_keys(df, wide, names, "left_semi")
    types = {f.name: f.dataType for f in usual.schema.fields}
    if firsts:
        heads = written(rows.groupBy(*names).agg(*first_cols).select(*names, *head_cols), "group-heads")
    else:
        heads = wide
    pieces = [written(_array_parts(rows, names, a, part_rows), "array-parts") for a in arrays]
    spine = heads.select(*names, F.lit(0).alias("part"))
    for piece in pieces:
        spine = spine.unionByName(piece.select(*names, "part"))
    joined = spine.distinct()
    for piece in pieces:
        joined = _with_keys(joined, piece, [*names, "part"], "left")
    joined = joined.withColumns({a: F.coalesce(a, F.array().cast(types[a])) for a in array_names})
    if firsts:
        joined = _with_keys(joined, heads, names, "left")
    return usual.unionByName(joined.select(*usual.columns))


def nest_set(
    df: DataFrame,
    keys: str | Sequence[str],
    fields: dict[str, ColumnOrName] | Column,
    name: str = "items",
    when: Column | None = None,
    part_rows: int = PART_ROWS,
    large: bool | int | None = None,
) -> DataFrame:
    """Sorted array of the distinct elements of every key; rows failing ``when`` add none."""
    element = fields if isinstance(fields, Column) else fields_struct(fields)
    return nest(df, keys, [Nested(name, element, when=when)], part_rows=part_rows, large=large)


def nest_list(
    df: DataFrame,
    keys: str | Sequence[str],
    fields: dict[str, ColumnOrName] | Column,
    order_by: Sequence[ColumnOrName] = (),
    name: str = "items",
    when: Column | None = None,
    part_rows: int = PART_ROWS,
    large: bool | int | None = None,
) -> DataFrame:
    """Array of all elements of every key in the given order, copies included."""
    element = fields if isinstance(fields, Column) else fields_struct(fields)
    array = Nested(name, element, when=when, distinct=False, order_by=tuple(order_by))
    return nest(df, keys, [array], part_rows=part_rows, large=large)
