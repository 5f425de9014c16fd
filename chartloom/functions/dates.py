"""Date repair: zero dates, epoch numbers, age, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column

# Epoch milliseconds of any date after March 1973 exceed this; epoch seconds do not before the year 5138.
MILLIS_THRESHOLD = 100_000_000_000
# The threshold of the unguarded rule, which also hits ids and round epoch seconds.
LITERAL_THRESHOLD = 1_000_000_000


def zero_date_to_null(column: ColumnOrName) -> Column:
    """Text to timestamp; zero dates and text that is no date give NULL."""
    c = as_column(column)
    return F.when(c.like("0000-00-00%"), F.lit(None)).otherwise(F.try_to_timestamp(c))


def from_epoch(column: ColumnOrName, unit: str = "ms") -> Column:
    """Epoch number, or text holding one, to a timestamp of whole seconds."""
    number = as_column(column).try_cast("bigint")
    if unit == "ms":
        # Towards zero, in whole seconds.
        return F.timestamp_seconds(F.call_function("div", number, F.lit(1000)))
    if unit == "s":
        return F.timestamp_seconds(number)
    raise ValueError(f"unknown epoch unit {unit!r}")


def normalise_epoch(column: ColumnOrName, threshold: int = MILLIS_THRESHOLD) -> Column:
    """Epoch milliseconds to seconds by size; apply it to date columns only.

    ``threshold=LITERAL_THRESHOLD`` gives the unguarded rule.
    """
    c = as_column(column).cast("bigint")
    is_millis = (c > F.lit(threshold)) & (c % 1000 == 0)
    return F.when(is_millis, F.call_function("div", c, F.lit(1000))).otherwise(c)


def flag_to_bool(column: ColumnOrName) -> Column:
    """0 is false; everything else, NULL included, is true."""
    return F.when(as_column(column) == 0, F.lit(False)).otherwise(F.lit(True))


def to_number(column: ColumnOrName) -> Column:
    """Text to double; text that is no number gives NULL."""
    return as_column(column).try_cast("double")


def age_years(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Difference of the calendar years."""
    return F.year(as_column(as_of)) - F.year(as_column(birth))


def in_return_window(column: ColumnOrName, date: ColumnOrName, back: int = 28, ahead: int = 2) -> Column:
    """From ``back`` days before the date to midnight ``ahead`` days after it, both included."""
    day = as_column(date).cast("date")
    return as_column(column).between(
        F.date_sub(day, back).cast("timestamp_ntz"), F.date_add(day, ahead).cast("timestamp_ntz")
    )
