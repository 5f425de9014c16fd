"""Document keys and display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column


def doc_key(prefix: str, *parts: ColumnOrName) -> Column:
    """``prefix_part1_part2``; NULL parts are left out."""
    return F.concat_ws("_", F.lit(prefix), *[as_column(p).cast("string") for p in parts])


def full_name(*parts: ColumnOrName) -> Column:
    """Given, middle and family name joined by blanks; NULL parts are left out."""
    return F.concat_ws(" ", *[as_column(p) for p in parts])


def display(*parts: ColumnOrName, sep: str = " ") -> Column:
    """Display text such as ``name = value``; names mean columns, use ``F.lit`` for fixed text."""
    return F.concat_ws(sep, *[as_column(p).cast("string") for p in parts])
