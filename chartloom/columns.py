"""Small helpers on columns and column lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def row_type(**fields: str | T.DataType) -> T.StructType:
    """A struct type from names and types; needs no session, unlike a DDL string."""
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_list(value: ColumnOrName | Sequence[ColumnOrName]) -> list[ColumnOrName]:
    return [value] if isinstance(value, (str, Column)) else list(value)


def fields_struct(fields: dict[str, ColumnOrName] | Iterable[str]) -> Column:
    """A struct from ``{name: column}`` or from a list of column names."""
    if isinstance(fields, dict):
        return F.struct(*[as_column(c).alias(name) for name, c in fields.items()])
    return F.struct(*[F.col(name) for name in fields])


def is_atomic(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory size of one row: 16 bytes a field plus the text it holds."""
    size: Column = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif not is_atomic(field.dataType):
            text = F.to_json(F.struct(column))
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size
