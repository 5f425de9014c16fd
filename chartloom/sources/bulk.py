"""Bulk files: documents as JSON lines by database, the form bulk loaders of document databases take.

A Python data source writes them. Every task writes files of its own below ``files/db=NAME`` and tells the driver their names in its
commit message; the driver then creates ``batches/BATCH.json`` with the names of all, and only files named there count
(``bulk_files``). That file must not exist, so a batch that is written again, as after a restart of a stream, adds nothing: its new
files are removed. Files of tasks that were tried twice, or of a write that failed, are named nowhere.

The folder is reached through ``pyarrow.fs`` in the tasks, so it needs a path or address that Arrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from chartloom.functions.json import to_doc_json
from chartloom.session import ship

NAME = "document_bulk_files"
DB = "db"
BULK_SIZE = 1_000_000


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class _Files:
    """What batch and stream writers have in common."""

    def __init__(self, options: dict):
        self.path, self.size = options["path"].rstrip("/"), int(options.get("bulk_size", BULK_SIZE))
        self.batch = options.get("batch") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Lines of one task, in files of at most ``bulk_size``; rows come in order of their database."""
        system, root = located(self.path)
        names: list[str] = []
        out, db, lines = None, None, 0
        for batch in iterator:
            for part in pa.Table.from_batches([batch]).group_by(DB, use_threads=False).aggregate([]).column(DB).to_pylist():
                own = batch.filter(pc.is_null(batch.column(DB)) if part is None else pc.equal(batch.column(DB), part))
                values = own.column("value").to_pylist()
                while values:
                    if out is None or part != db or lines >= self.size:
                        if out is not None:
                            out.close()
                        db, lines = part, 0
                        names.append(f"files/db={db}/{uuid.uuid4().hex}.jsonl")
                        system.create_dir(f"{root}/files/db={db}", recursive=True)
                        out = system.open_output_stream(f"{root}/{names[-1]}")
                    now, values = values[: self.size - lines], values[self.size - lines :]
                    out.write("".join(f"{v}\n" for v in now).encode())
                    lines += len(now)
        if out is not None:
            out.close()
        return Written(names)

    def _commit(self, messages: list[Written | None], batch: str) -> None:
        system, root = located(self.path)
        names = [n for m in messages if m is not None for n in m.names]
        place = f"{root}/batches/{batch}.json"
        if system.get_file_info(place).type != fs.FileType.NotFound:
            self._remove(names)
            return
        system.create_dir(f"{root}/batches", recursive=True)
        # Complete before it has its name.
        with system.open_output_stream(f"{place}.part") as out:
            out.write(json.dumps(names).encode())
        system.move(f"{place}.part", place)

    def _remove(self, names: list[str]) -> None:
        system, root = located(self.path)
        for name in names:
            system.delete_file(f"{root}/{name}")

    def _abort(self, messages: list[Written | None]) -> None:
        self._remove([n for m in messages if m is not None for n in m.names])


class _BatchWriter(_Files, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self._commit(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self._abort(messages)


class _StreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._commit(messages, f"{self.batch}-{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._abort(messages)


class BulkFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(dict(self.options))


def bulk_lines(df: DataFrame) -> DataFrame:
    """``db, value``: documents as JSON text. Known revisions go along; a removal is its key, revision and ``_deleted``."""
    own = [c for c in df.columns if c not in (DB, "_deleted")]
    gone = F.coalesce(F.col("_deleted"), F.lit(False)) if "_deleted" in df.columns else F.lit(False)
    kept = [c for c in ("_id", "_rev") if c in own]
    line = F.when(gone, F.to_json(F.struct(*kept, F.lit(True).alias("_deleted")))).otherwise(to_doc_json(F.struct(*own)))
    return df.select(F.col(DB).cast("string").alias(DB), line.alias("value"))


def write_bulk_files(df: DataFrame, path: str, batch: str, bulk_size: int = BULK_SIZE) -> None:
    """Write documents with the column ``db``; a batch that is there already adds nothing."""
    _registered(df.sparkSession)
    lines = bulk_lines(df).hint("rebalance", F.col(DB)).sortWithinPartitions(DB)
    lines.write.format(NAME).mode("append").options(path=path, batch=batch, bulk_size=str(bulk_size)).save()


def stream_bulk_files(stream: DataFrame, path: str, name: str, checkpoint: str, bulk_size: int = BULK_SIZE) -> DataStreamWriter:
    """The same for a stream, one batch for each micro-batch; ``name`` names the stream in its batches."""
    _registered(stream.sparkSession)
    out = bulk_lines(stream).writeStream.format(NAME).option("checkpointLocation", checkpoint)
    return out.options(path=path, batch=name, bulk_size=str(bulk_size))


def bulk_files(path: str) -> list[str]:
    """Files of all batches that were written completely."""
    system, root = located(path.rstrip("/"))
    found = system.get_file_info(fs.FileSelector(f"{root}/batches", allow_not_found=True))
    names: list[str] = []
    for info in sorted(found, key=lambda i: i.path):
        if info.path.endswith(".json"):
            with system.open_input_stream(info.path) as stream:
                names += json.loads(stream.read())
    return [f"{path.rstrip('/')}/{n}" for n in names]


def read_bulk_files(spark: SparkSession, path: str) -> DataFrame:
    """``db, value`` of all complete batches."""
    files = bulk_files(path)
    if not files:
        return spark.createDataFrame([], "db string, value string")
    return spark.read.option("basePath", f"{path.rstrip('/')}/files").text(files).select(F.col(DB).cast("string").alias(DB), "value")


def _registered(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(BulkFiles)
