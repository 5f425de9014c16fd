"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the jobs are planned for. They are offered to whoever builds the session;
# the library itself never changes a running session.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose skewed side must be split is split even if that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Nesting works on many small groups per task; the default of 128 hash entries would
    # send every task to the sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def with_recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application, as ``--py-files`` would."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="chartloom-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(name)
    _shipped.add(spark.sparkContext.applicationId)


# Folders made since the innermost ``temporary_folders`` began.
_made: ContextVar[list[str] | None] = ContextVar("work_folders", default=None)


@contextmanager
def temporary_folders(spark: SparkSession) -> Iterator[None]:
    """Work folders made inside are removed at the end, also after an error; frames read from them must be used up by then."""
    mine: list[str] = []
    token = _made.set(mine)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in mine:
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder on storage that every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="chartloom-")
    folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


# The names that Spark 4.1 and earlier ones give the setting.
_FREEING = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled")


def freeing(df: DataFrame) -> DataFrame:
    """The frame, to be written: the shuffle files of doing so are freed at once.

    They would stay until the driver happens to collect its garbage. The setting is that of a clone of the session, which
    plans this write only; the running session keeps its own.
    """
    spark = df.sparkSession
    clone = spark._jsparkSession.cloneSession()
    for key in _FREEING:
        clone.conf().set(key, "true")
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(clone, df._jdf.queryExecution().analyzed()), spark)


def save(df: DataFrame, path: str) -> None:
    freeing(df).write.option("compression", "zstd").parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """The frame as a table in the work folder that is dealt by a key as a shuffle would deal it, so that what groups or joins it by the key moves nothing.

    The catalog has the table only while it is made.
    """
    spark, name = df.sparkSession, f"chartloom_{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = freeing(df.repartition(tasks, key)).write.option("compression", "zstd").option("path", work_dir(spark, label))
    try:
        out.bucketBy(tasks, key).saveAsTable(name)
        return spark.table(name).select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in df.schema.fields])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the work folder: computed once, and of a size Spark knows.

    Spark then broadcasts it in joins if its files are small, and only then.
    """
    path = work_dir(df.sparkSession, label)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """The frame that ``make`` returns as a written table, and its folder; the folders made on the way to it are removed."""
    path = work_dir(spark, label)
    with temporary_folders(spark):
        df = make()
        save(df, path)
    return spark.read.schema(df.schema).parquet(path), path


def concurrently(*makers: Callable[[], object]) -> list:
    """Make frames whose plans depend on size checks, with the checks running as concurrent jobs."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(makers)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, inherit(make)) for make in makers]]
