"""Tables that are changed by key without rewriting them.

An append to a keyed store replaces the rows of the same key. On plain files this is a folder
``data/batch=ID`` with an id of its own for every append, and a file ``commits/N.json`` once that append
is complete. A commit takes the next free number by creating its file, which fails if another writer has
it, so writers at the same time lose nothing and never touch each other's folders.

A key is a register. Its commits apply in order; rows with a ``POSITION`` (the place of a change in its stream) apply only
if they are not older than the position the key has, so a stream that is read again, or late, puts no old state back. Rows without a
position always apply. All rows that a batch wrote for a key belong together.

A *base* is a commit that stands for all up to a number it has read: ``compact`` for the commits it folded, a full load
for those there were when its reading began (``version``), so appends made meanwhile still count. Only commits
since the last base are read. After ``COMPACT_AFTER`` appends the writer that notices makes a new base; ``vacuum`` removes what no reader
needs after a time. A repeated batch of a stream changes nothing; a base carries the last batch of every writer on.

A table may be *bucketed* by a column that its keys determine, such as the person: rows are in one folder for each hash bucket and
sorted by key, and readers who name the people they want open the buckets of these only.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.columns import as_list
from chartloom.operators.relational import BROADCAST_BYTES, missing_from, restrict_to
from chartloom.session import freeing

BATCH = "batch"
BUCKET = "bucket"
DELETED = "_deleted"
POSITION = "__position"

COMPACT_AFTER = 64
BUCKETS = 32
RETAIN_SECONDS = 7 * 24 * 3600
# Keys take at most this many times the bytes of the compressed files they are in.
EXPANSION = 8


class KeyedTable:
    """A keyed table of parquet files in a folder, optionally in subfolders by a column and by buckets of another."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | Sequence[str],
        partition_by: str | None = None,
        bucket_by: str | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = as_list(keys)
        self.partition_by = partition_by
        self.bucket_by = bucket_by
        self.buckets = buckets
        self._known: dict[str, dict] = {}

    # -- commits ------------------------------------------------------------------------------

    def _folder(self, name: str):
        """A folder of the table in Hadoop's file system, and that system."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        system, path = self._folder(folder)
        return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []

    def _create(self, name: str, text: str) -> bool:
        """Write a file; False if there is one already."""
        system, path = self._folder(name)
        try:
            out = system.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName() and not system.exists(path):
                raise
            return False
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _numbered(self) -> list[str]:
        return [n for n in self._names("commits") if n.endswith(".json") and not n.startswith(".")]

    def _loaded(self, names: list[str]) -> list[dict]:
        """Commit files, which never change, in order of their numbers."""
        for name in names:
            if name not in self._known:
                system, path = self._folder(f"commits/{name}")
                stream = system.open(path)
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                if not text:
                    continue  # created, but not yet written
                self._known[name] = json.loads(text)
        return sorted((self._known[n] for n in names if n in self._known), key=lambda c: c["number"])

    def _commits(self) -> list[dict]:
        """The last base, if there is one, and the appends that it does not stand for, in order."""
        bases = [tuple(map(int, name.split("_"))) for name in self._names("bases") if not name.startswith(".")]
        number, covers = max(bases, key=lambda b: (b[1], b[0]), default=(-1, -1))
        found = self._loaded([n for n in self._numbered() if int(n[:-5]) == number or int(n[:-5]) > covers])
        # A base whose writer ended before it could be listed counts as well.
        number, covers = max([(c["number"], c["covers"]) for c in found if c["base"]], key=lambda b: (b[1], b[0]), default=(-1, -1))
        return [c for c in found if c["number"] == number] + [c for c in found if not c["base"] and c["number"] > covers]

    def version(self) -> int:
        """Number of the last commit; -1 before the first."""
        names = self._numbered()
        return int(names[-1][:-5]) if names else -1

    def exists(self) -> bool:
        return bool(self._names("commits"))

    # -- writes -------------------------------------------------------------------------------

    def _bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value.cast("string")), F.lit(self.buckets)).cast("int")

    def _append(self, df: DataFrame, commit: dict, options: dict) -> None:
        if DELETED not in df.columns:
            df = df.withColumn(DELETED, F.lit(False))
        folders = [self.partition_by] if self.partition_by else []
        if self.bucket_by:
            # Removals that name keys only are in the folder without a bucket, which every reader opens.
            known = self._bucket(F.col(self.bucket_by)) if self.bucket_by in df.columns else F.lit(None).cast("int")
            df = df.withColumn(BUCKET, known)
            folders.append(BUCKET)
        commit = commit | {"id": uuid.uuid4().hex, "columns": df.schema.json()}
        if folders:
            # Files of even size for every folder: small ones are merged, a dominant one is split.
            df = df.hint("rebalance", *[F.col(c) for c in folders])
        if self.bucket_by:
            df = df.sortWithinPartitions(*folders, *self.keys)
        out = freeing(df).write.mode("error").options(**options)
        if folders:
            out = out.partitionBy(*folders)
        folder = f"data/{BATCH}={commit['id']}"
        out.parquet(f"{self.path}/{folder}")
        system, path = self._folder(folder)
        commit["bytes"] = system.getContentSummary(path).getLength()
        number = self.version() + 1
        while not self._create(f"commits/{number:012d}.json", json.dumps(commit | {"number": number})):
            number += 1
        if commit["base"]:
            self._create(f"bases/{number}_{commit['covers']}", "")

    def upsert(
        self, df: DataFrame, writer: str | None = None, writer_batch: int | None = None, **options: object
    ) -> bool:
        """Replace the rows of all keys in ``df``; False if this writer's batch is already in."""
        commits = self._commits()
        if writer is not None and any(c["writers"].get(writer) == writer_batch for c in commits):
            return False
        own = {} if writer is None else {writer: writer_batch}
        self._append(df, {"base": False, "covers": None, "full": False, "writers": own}, options)
        if len(commits) >= COMPACT_AFTER:
            self.compact()
            self.vacuum()
        return True

    def delete(self, keys: DataFrame, writer: str | None = None, writer_batch: int | None = None) -> bool:
        """Remove the rows of all keys in ``keys``."""
        more = [c for c in (self.bucket_by, POSITION) if c and c in keys.columns and c not in self.keys]
        rows = keys.select(*self.keys, *more).distinct().withColumn(DELETED, F.lit(True))
        return self.upsert(rows, writer, writer_batch)

    def replace(self, df: DataFrame, seen: int | None = None, note: dict | None = None, **options: object) -> None:
        """Full load. It stands for the commits up to ``seen``, the version before its sources were read (now, by default).

        ``note`` is kept with the commit, for consumers that keep their place here.
        """
        commits = self._commits()
        covers = self.version() if seen is None else seen
        writers = _last_batches([c for c in commits if c["number"] <= covers])
        self._append(df, {"base": True, "covers": covers, "full": True, "writers": writers, "note": note}, options)

    def note(self) -> dict:
        """What the last full load noted."""
        return next((c.get("note") or {} for c in self._commits() if c["base"]), {})

    def compact(self) -> None:
        """Write the current rows as a new base, so that readers have no appends to merge."""
        commits = self._commits()
        covers = max(c["number"] for c in commits)
        rows = self._rows(commits)
        # A removal at a position is still needed to keep older changes out.
        if POSITION in rows.columns:
            rows = rows.where(~F.col(DELETED) | F.col(POSITION).isNotNull())
        else:
            rows = rows.where(~F.col(DELETED)).drop(DELETED)
        self._append(rows.drop(BATCH), {"base": True, "covers": covers, "full": False, "writers": _last_batches(commits)}, {})

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS) -> None:
        """Remove batches that the last base stands for and that were committed so long ago that no reader uses them."""
        needed = {c["number"] for c in self._commits()}
        covers = max((c["covers"] for c in self._commits() if c["base"]), default=-1)
        system, folder = self._folder("commits")
        limit = (time.time() - retain_seconds) * 1000
        old = {f.getPath().getName() for f in system.listStatus(folder) if f.getModificationTime() <= limit} if covers >= 0 else set()
        base = next((c["number"] for c in self._commits() if c["base"]), -1)
        gone = [c for c in self._loaded(self._numbered()) if c["number"] not in needed and (c["number"] <= covers or c["base"] and c["number"] < base)]
        for commit in gone:
            name = f"{commit['number']:012d}.json"
            if name in old:
                # The commit goes first: a batch without one is not read.
                for place in (f"commits/{name}", f"bases/{commit['number']}_{commit['covers']}", f"data/{BATCH}={commit['id']}"):
                    files, path = self._folder(place)
                    files.delete(path, True)

    # -- reads --------------------------------------------------------------------------------

    def _batches(self, commits: list[dict], near: Column | None = None) -> DataFrame | None:
        """Rows of some batches with the numbers of their commits; batches of one schema are read together."""
        by_columns: dict[str, list[dict]] = {}
        for commit in commits:
            by_columns.setdefault(commit["columns"], []).append(commit)
        if not by_columns:
            return None

        def read(columns: str, own: list[dict]) -> DataFrame:
            schema = T.StructType.fromJson(json.loads(columns)).add(BATCH, T.StringType())
            paths = [f"{self.path}/data/{BATCH}={c['id']}" for c in own]
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
            if near is not None:
                rows = rows.where(near)
            numbers = F.create_map(*[F.lit(x) for c in own for x in (c["id"], c["number"])])
            return rows.withColumn(BATCH, numbers[F.col(BATCH)]).drop(BUCKET)

        frames = [read(columns, own) for columns, own in by_columns.items()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def read(self, of: DataFrame | None = None) -> DataFrame:
        """Current rows; of a bucketed table those of the values in ``of`` only, whose buckets alone are opened."""
        commits = self._commits()
        if not commits:
            raise FileNotFoundError(f"no committed data in {self.path}")
        near = None
        if of is not None:
            wanted = of.select(self._bucket(F.col(self.bucket_by)).alias(BUCKET)).distinct().collect()  # at most all buckets
            near = F.col(BUCKET).isin([r[BUCKET] for r in wanted if r[BUCKET] is not None]) | F.col(BUCKET).isNull()
        rows = self._rows(commits, near)
        rows = rows.where(~F.col(DELETED)).drop(DELETED, BATCH, POSITION)
        return rows if of is None else restrict_to(rows, of.select(self.bucket_by).distinct(), self.bucket_by)

    def changes_since(self, number: int) -> DataFrame | None:
        """Distinct keys (and values of the bucket column) written by commits after ``number``.

        None where that is not known, or is everything: after a full load, or if these commits were removed. A consumer keeps the
        ``version`` it has read as its number.
        """
        names = self._numbered()
        commits = [c for c in self._loaded([n for n in names if int(n[:-5]) > number])]
        kept = {int(n[:-5]) for n in names}
        if any(c["full"] for c in commits) or any(k not in kept for k in range(max(number + 1, 0), self.version() + 1)):
            return None
        appended = self._batches([c for c in commits if not c["base"]])
        more = [self.bucket_by] if self.bucket_by and self.bucket_by not in self.keys else []
        if appended is None:
            known = [c for c in self._loaded(names)]
            if not known:
                return None
            appended = self._batches(known[-1:]).limit(0)
        missing = [c for c in more if c not in appended.columns]
        return appended.withColumns({c: F.lit(None) for c in missing}).select(*self.keys, *more).distinct()

    def _rows(self, commits: list[dict], near: Column | None = None) -> DataFrame:
        """Rows as of some commits, with marks of removal, batches and positions.

        The base is unique by key and is only filtered by the keys appended since, which are few; the appends
        alone are aggregated. Their keys are broadcast if the bytes of their files, which the commits name, bound them.
        """
        newer = [c for c in commits if not c["base"]]
        base = self._batches([c for c in commits if c["base"]], near)
        appended = self._batches(newer, near)
        if appended is None:
            return base.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
        if len(newer) == 1 and base is None:
            # Nothing replaces rows of an only batch.
            return appended.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
        covers = next((c["covers"] for c in commits if c["base"]), -1)
        small = EXPANSION * sum(c["bytes"] for c in newer) <= BROADCAST_BYTES
        some = lambda df: F.broadcast(df) if small else df
        if POSITION not in appended.columns and (base is None or POSITION not in base.columns):
            newest = appended.groupBy(*self.keys).agg(F.max(BATCH).alias(BATCH))
        else:
            kind = next(df.schema[POSITION].dataType for df in (appended, base) if df is not None and POSITION in df.columns)

            def placed(df: DataFrame) -> DataFrame:
                at = F.col(POSITION) if POSITION in df.columns else F.lit(None).cast(kind)
                return df.select(*self.keys, F.col(BATCH).cast("int").alias(BATCH), at.alias(POSITION))

            writes = placed(appended)
            if base is not None:
                keys = appended.select(*self.keys).distinct()
                # A base may have a later number than appends that it does not stand for; it comes before them.
                first = base.withColumn(BATCH, F.lit(covers))
                writes = writes.unionByName(placed(first).join(some(keys), self.keys, "left_semi"))
            writes = writes.groupBy(*self.keys, BATCH).agg(F.max(POSITION).alias(POSITION))
            newest = writes.groupBy(*self.keys).agg(_applied(F.array_sort(F.collect_list(F.struct(BATCH, POSITION))), kind).alias(BATCH))
        current = appended.join(some(newest), [*self.keys, BATCH], "left_semi")
        if base is not None:
            kept = missing_from(base, some(newest.where(F.col(BATCH) > covers)), self.keys)
            current = kept.unionByName(current, allowMissingColumns=True)
        return current.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))


def _applied(writes: Column, kind: T.DataType) -> Column:
    """The batch that stands after writes (batch, position) of one key were applied in order: at most one for each commit since the base."""
    begin = F.struct(F.lit(None).cast("int").alias(BATCH), F.lit(None).cast(kind).alias(POSITION))

    def apply(state: Column, write: Column) -> Column:
        late = F.coalesce(write[POSITION] < state[POSITION], F.lit(False))
        after = F.struct(write[BATCH].cast("int").alias(BATCH), F.coalesce(write[POSITION], state[POSITION]).alias(POSITION))
        return F.when(late, state).otherwise(after)

    return F.aggregate(writes, begin, apply, lambda state: state[BATCH])


def _last_batches(commits: list[dict]) -> dict:
    """The last batch of every writer."""
    return {writer: batch for c in commits for writer, batch in c["writers"].items()}
