"""Most recent rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column, as_list


def latest_n(
    df: DataFrame,
    keys: ColumnOrName | Sequence[ColumnOrName],
    order_by: ColumnOrName | Sequence[ColumnOrName],
    n: int = 10,
    tiebreak: ColumnOrName | Sequence[ColumnOrName] = (),
) -> DataFrame:
    """The ``n`` latest rows of every key; equal times fall back to ``tiebreak``, also descending.

    The limit on the row number lets Spark drop all but ``n`` rows of a key in every task before
    the shuffle, so a key that holds much of the table costs no more than any other.
    """
    order = [as_column(c).desc() for c in (*as_list(order_by), *as_list(tiebreak))]
    window = Window.partitionBy(*[as_column(k) for k in as_list(keys)]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") <= n).drop("__rank")
