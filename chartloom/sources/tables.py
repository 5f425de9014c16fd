"""Scans of source tables: parquet folders or a relational database."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.columns import ColumnOrName, as_column, row_bytes
from chartloom.operators.nesting import marked_dealt
from chartloom.operators.relational import BROADCAST_BYTES

# Up to this many keys are pushed to the source as literals.
LITERAL_KEYS = 1_000


@dataclass(frozen=True)
class ParquetTables:
    """One parquet file or folder per table below ``root``."""

    root: str
    suffix: str = ".parquet"


class Stride(NamedTuple):
    """How a database table is read in ranges: numeric column, bounds of the stride, number of ranges."""

    column: str
    lower: int
    upper: int
    n: int
    fetchsize: int = 10_000


@dataclass(frozen=True)
class JdbcTables:
    """A database. ``options`` go to the reader: user, password, driver and the like.

    Zero dates become NULL at the source where the driver has an option for it in the URL. A table
    with a stride is read by many connections, any other by one.
    """

    url: str
    options: dict[str, str] = field(default_factory=dict)
    strides: dict[str, Stride] = field(default_factory=dict)


Source = ParquetTables | JdbcTables


def read_table(spark: SparkSession, source: Source, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole table, or some of its columns."""
    if isinstance(source, ParquetTables):
        df = spark.read.parquet(f"{source.root.rstrip('/')}/{name}{source.suffix}")
    else:
        df = spark.read.format("jdbc").options(**source.options).options(url=source.url, dbtable=name).load()
    return df.select(*columns) if columns else df


def stride_options(column: str, lower: int, upper: int, n: int, fetchsize: int) -> dict[str, str]:
    """Reader options of a database scan by ranges of a numeric column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(n),
        "fetchsize": str(fetchsize),
    }


def read_partitioned(
    spark: SparkSession,
    source: JdbcTables,
    name: str,
    column: str,
    lower: int,
    upper: int,
    n: int,
    fetchsize: int = 10_000,
) -> DataFrame:
    """Whole database table by ranges of equal width. Files come in splits of their own."""
    options = stride_options(column, lower, upper, n, fetchsize)
    reader = spark.read.format("jdbc").options(**source.options).options(**options)
    return reader.options(url=source.url, dbtable=name).load()


def balanced_ranges(df: DataFrame, column: str, n: int) -> list[str]:
    """Predicates of up to ``n`` ranges of a numeric column that hold about as many rows each; rows without a value are in the first.

    Bounds are quantiles, found in one pass with an error of an eighth of a range. Ranges are fewer where a value is so frequent that
    it fills several.
    """
    probabilities = [k / n for k in range(1, n)]
    found = df.where(F.col(column).isNotNull()).approxQuantile(column, probabilities, 1 / (8 * n)) if n > 1 else []
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    bounds = sorted({int(b) if whole else b for b in found})
    name = f"`{column}`"
    if not bounds:
        return ["1 = 1"]
    first = f"{name} < {bounds[0]} OR {name} IS NULL"
    middle = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(bounds, bounds[1:], strict=False)]
    return [first, *middle, f"{name} >= {bounds[-1]}"]


def read_ranges(spark: SparkSession, source: Source, name: str, column: str, n: int) -> DataFrame:
    """Whole table by balanced ranges of a column, which need not be evenly filled.

    A database is asked for each range by a connection of its own. From files, each range is a scan that its predicate prunes by
    the statistics of row groups.
    """
    ranges = balanced_ranges(read_table(spark, source, name, [column]), column, n)
    if isinstance(source, JdbcTables):
        plain = [r.replace("`", "") for r in ranges]
        return spark.read.jdbc(source.url, name, predicates=plain, properties=source.options)
    df = read_table(spark, source, name)
    return reduce(DataFrame.unionAll, [df.where(r) for r in ranges])


class SourceTables(Mapping):
    """The tables of a source by name, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, source: Source, names: Sequence[str]):
        self.names = list(names)

        @cache
        def read(name: str) -> DataFrame:
            stride = source.strides.get(name) if isinstance(source, JdbcTables) else None
            if stride is None:
                return read_table(spark, source, name)
            return read_partitioned(spark, source, name, *stride)

        self.read = read

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        return self.read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


@dataclass(frozen=True)
class KeySet:
    """Distinct keys that were looked at once: few as a list, many as a frame with their range."""

    rows: DataFrame
    low: object
    high: object
    values: list | None
    small: bool = True


def key_sets(keys: Mapping[str, DataFrame], literal_keys: int = LITERAL_KEYS) -> dict[str, KeySet]:
    """Key sets by the name of the column that holds the keys, all looked at by one job.

    It brings their numbers, ranges and sizes, and of each set the first ``literal_keys`` keys.
    """
    live = {c: df.select(F.col(c).alias("__key")).where(F.col("__key").isNotNull()) for c, df in keys.items()}
    types = {c: df.schema["__key"].dataType.simpleString() for c, df in live.items()}
    # A column for each type of keys.
    slots = {t: f"key_{i}" for i, t in enumerate(sorted(set(types.values())))}
    named = [df.select(F.lit(c).alias("of"), F.col("__key").alias(slots[types[c]]), row_bytes(df).alias("bytes")) for c, df in live.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).distinct()
    ends = [end(k).alias(f"{name}_{k}") for k in slots.values() for name, end in (("low", F.min), ("high", F.max))]
    seen = rows.groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), *ends)
    by_set = Window.partitionBy("of").orderBy(*slots.values())
    few = rows.drop("bytes").withColumn("at", F.row_number().over(by_set)).where(F.col("at") <= literal_keys).drop("at")
    values: dict[str, list] = {c: [] for c in keys}
    sizes: dict[str, Row] = {}
    for row in seen.unionByName(few, allowMissingColumns=True).collect():
        if row.n is None:
            values[row.of].append(row[slots[types[row.of]]])
        else:
            sizes[row.of] = row
    found = {}
    for c, df in live.items():
        size, slot, distinct = sizes.get(c), slots[types[c]], df.distinct()
        if size is None or size.n <= literal_keys:
            found[c] = KeySet(distinct, size and size[f"low_{slot}"], size and size[f"high_{slot}"], values[c])
        else:
            small = size.bytes <= BROADCAST_BYTES
            found[c] = KeySet(F.broadcast(distinct) if small else distinct, size[f"low_{slot}"], size[f"high_{slot}"], None, small)
    return found


def key_set(keys: DataFrame, column: str, literal_keys: int = LITERAL_KEYS) -> KeySet:
    """One key set, as ``key_sets``."""
    return key_sets({column: keys.select(column)}, literal_keys)[column]


def scan_by_keys(
    df: DataFrame,
    keys: DataFrame | KeySet,
    column: str,
    key_column: str | None = None,
    literal_keys: int = LITERAL_KEYS,
) -> DataFrame:
    """Rows whose ``column`` is among the keys.

    A micro-batch names few keys: they become an ``IN`` list, which a database answers from its
    index and a parquet scan from its row-group statistics. More keys stay a frame: a semi join,
    behind the range of the keys as a filter for the scan, with the keys broadcast if their
    measured size allows.
    """
    found = keys if isinstance(keys, KeySet) else key_set(keys, key_column or column, literal_keys)
    if found.values is not None:
        return filter_in(df, column, found.values)
    near = df.where(F.col(column).between(found.low, found.high))
    rows = near.join(found.rows, F.col(column) == F.col("__key"), "left_semi")
    # A join by shuffle leaves the rows dealt by the key.
    return rows if found.small else marked_dealt(rows, column)
