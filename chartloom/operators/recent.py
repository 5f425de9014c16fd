"""The latest rows of every key, kept up to date batch by batch.

The state holds at most ``n`` rows of each key. A batch is merged with the state of the keys it names; the history is only read for keys
that may have lost one of their latest rows to a removal, or to a change that made it older, while the state was full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.relational import missing_from, restrict_to
from chartloom.operators.windows import latest_n
from chartloom.session import temporary_folders, written
from chartloom.sources.keyed import DELETED, KeyedTable


class RecentRows:
    """Rows with ``key``, ``time`` and ``row_id``, which is unique within a key and decides between equal times."""

    def __init__(self, spark: SparkSession, path: str, key: str, time: str, row_id: str, n: int = 10):
        self.table = KeyedTable(spark, path, key, bucket_by=key)
        self.spark, self.key, self.time, self.row_id, self.n = spark, key, time, row_id, n

    def merge(
        self,
        batch: DataFrame,
        history: Callable[[DataFrame], DataFrame],
        writer: str | None = None,
        writer_batch: int | None = None,
    ) -> None:
        """Take over changed rows, and removals (``_deleted``), one row for each key and row id.

        ``history`` gives all rows of some keys as they are after the batch. All frames have the same columns.
        """
        with temporary_folders(self.spark):
            own = [self.key, self.row_id]
            if DELETED not in batch.columns:
                batch = batch.withColumn(DELETED, F.lit(False))
            batch = written(batch, "recent-batch")
            keys = batch.select(self.key).distinct()
            live = batch.where(~F.coalesce(DELETED, F.lit(False))).drop(DELETED)
            at = F.struct(self.time, self.row_id)
            if self.table.exists():
                state = written(self.table.read(of=keys).select(*live.columns), "recent-state")
                # Rows that the state does not hold are at most as late as the last one of a full state.
                full = state.groupBy(self.key).agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__last")).where(F.col("__n") >= self.n)
                rows = missing_from(state, batch, own).unionByName(live)
                top = written(latest_n(rows, self.key, self.time, self.n, self.row_id), "recent-top")
                sure = top.join(full.select(self.key, "__last"), self.key).where(at >= F.col("__last"))
                sure = sure.groupBy(self.key).count().where(F.col("count") >= self.n)
                doubtful = written(missing_from(full.select(self.key), sure, self.key), "recent-doubtful")
                again = latest_n(history(doubtful).select(*live.columns), self.key, self.time, self.n, self.row_id)
                top = missing_from(top, doubtful, self.key).unionByName(restrict_to(again, doubtful, self.key))
            else:
                top = latest_n(live, self.key, self.time, self.n, self.row_id)
            # Keys that have no row any more are removed.
            marked = keys.join(top.withColumn("__live", F.lit(True)), self.key, "left")
            marked = marked.withColumn(DELETED, F.col("__live").isNull()).drop("__live")
            self.table.upsert(marked, writer, writer_batch)

    def read(self, of: DataFrame | None = None) -> DataFrame:
        return self.table.read(of)
