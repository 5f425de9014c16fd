import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chartloom.columns import row_type
from chartloom.operators.recent import RecentRows
from chartloom.operators.relational import restrict_to
from chartloom.session import work_dir, written
from chartloom.sources.bulk import bulk_files, read_bulk_files, stream_bulk_files, write_bulk_files
from chartloom.sources.documents import database_exists, read_documents, read_manifest, write_documents
from chartloom.sources.keyed import KeyedTable
from chartloom.sources.staging import replace_staging, upsert_staging
from chartloom.sources.tables import balanced_ranges, filter_in, key_sets, read_ranges, read_table, scan_by_keys, stride_options, JdbcTables, ParquetTables


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), "k")


def test_append_replaces_by_key(table, rows):
    table.replace(rows("k int, v string", (1, "a"), (2, "b"), (3, "c")))
    table.upsert(rows("k int, v string", (2, "B"), (4, "d")))
    table.upsert(rows("k int, v string", (2, "BB")))
    table.delete(rows("k int", (3,), (9,)))
    want = [(1, "a"), (2, "BB"), (4, "d")]
    assert values(table.read()) == want
    table.compact()
    assert values(table.read()) == want
    table.upsert(rows("k int, v string", (3, "again")))
    assert values(table.read()) == sorted([*want, (3, "again")])


def test_without_a_base(table, rows):
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(rows("k int, v string", (1, "a")))
    table.upsert(rows("k int, v string, w int", (1, "b", 7)))
    assert values(table.read()) == [(1, "b", 7)]


def test_rows_of_one_batch_belong_together(table, rows):
    table.upsert(rows("k int, part int", (1, 0), (1, 1), (1, 2)))
    assert len(table.read().collect()) == 3
    table.upsert(rows("k int, part int", (1, 0)))
    assert values(table.read()) == [(1, 0)]


def test_a_repeated_batch_changes_nothing(table, rows):
    df = rows("k int, v string", (1, "a"))
    assert table.upsert(df, "job", 0)
    assert table.upsert(rows("k int, v string", (1, "b")), "other", 0)
    assert not table.upsert(df, "job", 0)
    assert values(table.read()) == [(1, "b")]


def test_an_unfinished_append_is_not_read(table, rows, spark):
    table.replace(rows("k int, v string", (1, "a")))
    rows("k int, v string, _deleted boolean", (1, "half", False)).write.parquet(f"{table.path}/data/batch=1")
    assert values(table.read()) == [(1, "a")]
    table.upsert(rows("k int, v string", (2, "b")))
    assert values(table.read()) == [(1, "a"), (2, "b")]


def test_interleaved_writers_lose_nothing(table, rows, spark):
    other = KeyedTable(spark, table.path, "k")
    table.replace(rows("k int, v string", (1, "a"), (2, "b")))
    listed = other._names("commits")
    table.upsert(rows("k int, v string", (2, "B")), "one", 0)
    # The other writer has listed the commits before, so it tries a number that is taken.
    other._names = lambda folder: listed if folder == "commits" else KeyedTable._names(other, folder)
    other._append(rows("k int, v string", (3, "c")), {"base": False, "covers": None, "writers": {"two": 0}}, {})
    assert values(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_an_append_during_compaction_stays(table, rows, monkeypatch):
    table.replace(rows("k int, v string", (1, "a")))
    table.upsert(rows("k int, v string", (2, "b")), "job", 7)
    before = table._commits()
    table.upsert(rows("k int, v string", (1, "late")))
    monkeypatch.setattr(table, "_commits", lambda: before)
    table.compact()
    monkeypatch.undo()
    assert values(table.read()) == [(1, "late"), (2, "b")]
    assert not table.upsert(rows("k int, v string", (2, "again")), "job", 7)


def test_appends_are_folded_after_a_number(table, rows, monkeypatch):
    monkeypatch.setattr("chartloom.sources.keyed.COMPACT_AFTER", 3)
    for k in range(6):
        table.upsert(rows("k int, v string", (k % 4, f"v{k}")), "job", k)
    assert table._names("bases")
    assert len(table._commits()) <= 4
    assert values(table.read()) == [(0, "v4"), (1, "v5"), (2, "v2"), (3, "v3")]


def test_an_append_during_a_full_load_stays(table, rows):
    table.upsert(rows("k int, v string", (1, "old"), (2, "old")))
    seen = table.version()
    table.upsert(rows("k int, v string", (2, "late"), (3, "late")))
    table.replace(rows("k int, v string", (1, "new"), (2, "new")), seen=seen)
    want = [(1, "new"), (2, "late"), (3, "late")]
    assert values(table.read()) == want
    table.compact()
    assert values(table.read()) == want


def test_two_writers_at_once(table, spark, rows):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        parts = [KeyedTable(spark, table.path, "k") for _ in range(4)]
        list(pool.map(lambda k: parts[k].upsert(spark.range(10).selectExpr(f"id + {10 * k} AS k", f"{k} AS w"), f"w{k}", 0), range(4)))
    assert values(table.read()) == sorted([(k, k // 10) for k in range(40)], key=repr)
    assert [c["number"] for c in table._commits()] == [0, 1, 2, 3]


PLACED = "k int, v string, __position struct<ts_ms: bigint, topic: string>"


def test_older_changes_do_not_apply(table, rows):
    at = lambda t, topic="a": (t, topic)
    table.upsert(rows(PLACED, (1, "new", at(9)), (2, "first", at(3)), (3, "x", at(5))))
    table.upsert(rows(PLACED, (1, "old", at(4)), (2, "second", at(3, "b")), (4, "only", None)))
    table.delete(rows(PLACED, (3, None, at(6))))
    table.upsert(rows(PLACED, (3, "before its removal", at(5, "z")), (4, "known", at(1))))
    want = [(1, "new"), (2, "second"), (4, "known")]
    assert values(table.read()) == want
    table.compact()
    assert values(table.read()) == want
    table.upsert(rows(PLACED, (1, "older", at(8)), (3, "still older", at(5)), (4, "older", at(0))))
    assert values(table.read()) == want
    # Rows without a position apply by the order of commits.
    table.upsert(rows("k int, v string", (1, "by hand")))
    table.upsert(rows(PLACED, (1, "late", at(7)), (3, "again", at(6, "z"))))
    assert values(table.read()) == [(1, "by hand"), (2, "second"), (3, "again"), (4, "known")]


def test_a_full_load_with_appends_it_has_not_seen_keeps_positions(table, rows):
    table.upsert(rows(PLACED, (1, "a", (5, "t"))))
    seen = table.version()
    table.upsert(rows(PLACED, (1, "b", (7, "t"))))
    table.replace(rows(PLACED, (1, "loaded", (6, "t")), (2, "loaded", (6, "t"))), seen=seen)
    table.upsert(rows(PLACED, (1, "late", (5, "t")), (2, "late", (5, "t"))))
    assert values(table.read()) == [(1, "b"), (2, "loaded")]


def test_buckets(spark, rows, tmp_path, capsys):
    own = KeyedTable(spark, str(tmp_path / "b"), "k", bucket_by="p", buckets=16)
    own.replace(spark.range(200).selectExpr("concat(id % 20, '_', id) AS k", "id % 20 AS p", "id AS v"))
    own.upsert(rows("k string, p int, v int", ("3_3", 3, -1), ("99_1", 99, 1)))
    own.delete(rows("k string", ("3_23",)))
    few = own.read(rows("p bigint", (3,), (3,), (None,)))
    assert values(few.select("k", "v")) == sorted([("3_3", -1), *[(f"3_{v}", v) for v in range(43, 200, 20)]], key=repr)
    few.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("bucket") and all("isnull(bucket" in line for line in plan.splitlines() if "PartitionFilters" in line)
    assert own.read().count() == 200


def test_changes_since(table, rows, spark):
    assert table.changes_since(-1) is None
    table.replace(rows("k int, v string", (1, "a"), (2, "b")))
    assert table.changes_since(-1) is None
    seen = table.version()
    assert values(table.changes_since(seen)) == []
    table.upsert(rows("k int, v string", (2, "B"), (3, "c"), (3, "c")))
    table.delete(rows("k int", (1,)))
    table.compact()
    assert values(table.changes_since(seen)) == [(1,), (2,), (3,)]
    assert values(table.changes_since(seen + 1)) == [(1,)]
    table.vacuum(-60)
    assert table.changes_since(seen) is None and values(table.changes_since(table.version())) == []
    assert values(table.read()) == [(2, "B"), (3, "c"), (3, "c")]


def test_vacuum_keeps_what_is_read(table, rows):
    table.upsert(rows("k int, v string", (1, "a")))
    table.vacuum(-60)
    assert values(table.read()) == [(1, "a")]
    table.compact()
    table.upsert(rows("k int, v string", (2, "b")))
    table.vacuum(3600)
    assert len(table._names("data")) == 3
    table.vacuum(-60)
    assert len(table._names("data")) == 2 and values(table.read()) == [(1, "a"), (2, "b")]


def test_documents_have_revisions(spark, rows, tmp_path):
    root = str(tmp_path / "docs")
    assert read_manifest(spark, root).count() == 0
    docs = rows("_id string, person_id bigint, build_date timestamp, body string", ("a", 1, datetime(2020, 1, 1), "x"), ("b", 2, None, None))
    with pytest.raises(FileNotFoundError):
        write_documents(docs, root, "one", create=False)
    write_documents(docs, root, "one", bulk_size=1)
    write_documents(docs.where("_id = 'a'"), root, "2")
    assert database_exists(spark, root, "2")
    manifest = read_manifest(spark, root, "one")
    assert values(manifest.select("_id", "person_id", "build_date")) == [("a", 1, datetime(2020, 1, 1)), ("b", 2, None)]
    again = docs.where("_id = 'a'").withColumns({"body": F.lit("y"), "_rev": F.lit("7-x")})
    write_documents(again, root, "one")
    write_documents(manifest.where("_id = 'b'").withColumn("_deleted", F.lit(True)), root, "one")
    schema = row_type(_id="string", _rev="string", body="string")
    stored = read_documents(spark, root, schema)
    assert values(stored.select("db", "_id", "body", "_rev")) == [("2", "a", "x", None), ("one", "a", "y", "7-x")]


def test_scans(spark, rows, tmp_path):
    source = ParquetTables(str(tmp_path))
    rows("k int, v string", *[(i, f"v{i}") for i in range(100)], (None, "none")).write.parquet(f"{source.root}/t.parquet")
    df = read_table(spark, source, "t", ["k"])
    assert df.columns == ["k"] and read_ranges(spark, source, "t", "k", 4).count() == 101
    keys = rows("id int", (3,), (3,), (None,), (500,))
    few = scan_by_keys(df, keys, "k", "id")
    many = scan_by_keys(df, keys, "k", "id", literal_keys=1)
    assert values(few) == values(many) == [(3,)]
    assert scan_by_keys(df, keys.where("id < 0"), "k", "id").count() == 0
    assert values(filter_in(df, "k", [1, 2])) == [(1,), (2,)]


def test_few_keys_reach_the_scan(spark, rows, tmp_path, capsys):
    rows("k int, v string", *[(i, f"v{i}") for i in range(100)]).write.parquet(str(tmp_path / "t.parquet"))
    df = read_table(spark, ParquetTables(str(tmp_path)), "t")
    scan_by_keys(df, rows("k int", (3,), (4,)), "k").explain()
    assert "In(k, [3,4])" in capsys.readouterr().out.split("PushedFilters")[1]


def test_range_options():
    assert stride_options("k", 1, 9, 3, 50)["numPartitions"] == "3"
    assert JdbcTables("jdbc:x").options == {}


def test_work_folder_is_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(f"{root}/x-")


def test_a_written_frame_leaves_no_shuffle_files(spark):
    """Shuffle files of a written frame go at once, and the setting of the running session is as before."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: tracker.shuffleStatuses().size()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df, setting, before = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), spark.conf.get(key), held()
    assert sorted(r["count"] for r in written(df, "counts").collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert held() <= before and spark.conf.get(key) == setting


def test_an_append_leaves_no_shuffle_files(spark, rows, tmp_path):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    table = KeyedTable(spark, f"{tmp_path}/freed", "k", bucket_by="p")
    df = rows("k int, p int", *[(i, i % 3) for i in range(30)]).groupBy("k").agg(F.max("p").alias("p"))
    before = tracker.shuffleStatuses().size()
    table.upsert(df)
    assert tracker.shuffleStatuses().size() <= before
    assert sorted((r.k, r.p) for r in table.read().collect()) == [(i, i % 3) for i in range(30)]


def test_balanced_ranges(spark, rows):
    df = spark.range(1000).selectExpr("CASE WHEN id % 10 <> 0 THEN id * id END AS v")
    ranges = balanced_ranges(df, "v", 5)
    sizes = [df.where(r).count() for r in ranges]
    assert len(ranges) == 5 and sum(sizes) == 1000
    assert max(sizes[1:]) <= 2 * min(sizes[1:]) and sizes[0] - 100 <= 2 * min(sizes[1:])
    # One value may fill several ranges, all rows may have none, and there may be no rows.
    same = rows("v int", *[(7,)] * 50, (1,), (None,))
    for odd in (same, same.where("v IS NULL"), same.limit(0)):
        found = balanced_ranges(odd, "v", 4)
        assert sum(odd.where(r).count() for r in found) == odd.count()
    assert balanced_ranges(df, "v", 1) == ["1 = 1"]


DOC = "db string, _id string, _rev string, _deleted boolean, n int"


def test_bulk_files(spark, rows, tmp_path):
    root = str(tmp_path / "bulk")
    assert bulk_files(root) == [] and read_bulk_files(spark, root).count() == 0
    docs = rows(DOC, ("a", "1", None, False, 1), ("a", "2", "3-x", False, 2), ("b", "1", "1-y", True, 3), ("b", "2", None, None, None))
    write_bulk_files(docs, root, "first", bulk_size=1)
    want = [
        ("a", {"_id": "1", "n": 1}),
        ("a", {"_id": "2", "_rev": "3-x", "n": 2}),
        ("b", {"_id": "1", "_rev": "1-y", "_deleted": True}),
        ("b", {"_id": "2"}),
    ]

    def stored():
        clean = lambda d: {k: v for k, v in json.loads(d).items() if v is not None}
        return sorted(((r.db, clean(r.value)) for r in read_bulk_files(spark, root).collect()), key=repr)

    assert stored() == sorted(want, key=repr) and len(bulk_files(root)) == 4
    write_bulk_files(docs, root, "first")
    assert stored() == sorted(want, key=repr)
    assert len([f for f in (tmp_path / "bulk/files").rglob("*.jsonl")]) == 4
    write_bulk_files(docs.where("db = 'a'"), root, "second")
    assert len(stored()) == 6


def test_a_failed_bulk_write_adds_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "bulk")
    broken = rows(DOC, ("a", "1", None, False, 1), ("b", "1", None, False, 0)).withColumn("m", F.expr("assert_true(n > 0)").cast("string"))
    with pytest.raises(Exception, match="n > 0"):
        write_bulk_files(broken, root, "one")
    assert bulk_files(root) == []


def test_bulk_stream(spark, tmp_path):
    root, inbox = str(tmp_path / "bulk"), tmp_path / "in"
    inbox.mkdir()
    for name in ("x", "y"):
        (inbox / f"{name}.txt").write_text(f"{name}1\n{name}2\n")
        docs = spark.readStream.text(str(inbox)).select(F.lit("d").alias("db"), F.col("value").alias("_id"))
        stream_bulk_files(docs, root, "job", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(json.loads(r.value)["_id"] for r in read_bulk_files(spark, root).collect()) == ["x1", "x2", "y1", "y2"]
    # A batch that was committed, but not noted in the checkpoint, is written again.
    for folder in ("commits",):
        (tmp_path / "checkpoint" / folder / "1").unlink()
        (tmp_path / "checkpoint" / folder / ".1.crc").unlink(missing_ok=True)
    stream_bulk_files(docs, root, "job", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert read_bulk_files(spark, root).count() == 4


def test_recent_rows(spark, rows, tmp_path):
    import random

    rng = random.Random(3)
    schema = "k int, t int, r int, v int, _deleted boolean"
    store, live = RecentRows(spark, str(tmp_path / "recent"), "k", "t", "r", n=3), {}
    reads = []

    def history(keys):
        reads.append([r.k for r in keys.collect()])
        return restrict_to(rows("k int, t int, r int, v int", *[(k, t, r, v) for (k, r), (t, v) in live.items()]), keys, "k")

    for number in range(5):
        batch = {}
        for _ in range(12):
            own = (rng.randint(1, 4), rng.randint(1, 8))
            batch[own] = (rng.randint(1, 30), rng.randint(1, 99), number > 0 and rng.random() < 0.4)
        for own, (t, v, gone) in batch.items():
            live.pop(own, None)
            if not gone:
                live[own] = (t, v)
        store.merge(rows(schema, *[(k, t, r, v, gone) for (k, r), (t, v, gone) in batch.items()]), history, "w", number)
        want = []
        for k in range(1, 5):
            own = sorted(((t, r, v) for (key, r), (t, v) in live.items() if key == k), reverse=True)[:3]
            want += [(k, t, r, v) for t, r, v in own]
        assert values(store.read().select("k", "t", "r", "v")) == sorted(want, key=repr)
    # A newer row needs no history.
    live[2, 99] = (100, 1)
    store.merge(rows(schema, (2, 100, 99, 1, False)), history, "w", 99)
    assert reads[-1] == []


def test_nightly_reads_only_what_changed(spark, rows, tmp_path, monkeypatch):
    from chartloom.plans import rebuild

    staging, target = str(tmp_path / "staging"), str(tmp_path / "target")
    visits = rows("person_id int, location_id int, rtc_date timestamp", *[(p, p % 2, datetime(2020, 1, 1)) for p in range(10)])
    docs = rows(
        "doc_id string, person_id int, encounter_id int, encounter_datetime timestamp, build_date timestamp, w int",
        *[(f"v{p}", p, p, datetime(2020, 1, 1), datetime(2020, 1, 1), 1) for p in range(10)],
    )
    read = []
    monkeypatch.setattr(rebuild, "read_staging", lambda *a, f=rebuild.read_staging, **k: read.append(sorted(r.person_id for r in k["people"].collect())) or f(*a, **k))
    upsert_staging(docs, staging, "vitals")

    def night(day=1):
        del read[:]
        rebuild.nightly_upsert(spark, staging, target, visits, F.to_date(F.lit(f"2020-01-{day:02}")), ["vitals"])
        return [p for people in read for p in people], read_manifest(spark, target).count()

    assert night() == (list(range(10)), 10)
    assert night() == ([], 10)
    upsert_staging(docs.where("person_id IN (3, 4)").withColumns({"w": F.lit(2), "build_date": F.lit(datetime(2020, 1, 2))}), staging, "vitals")
    assert night() == ([3, 4], 10)
    replace_staging(docs, staging, "vitals")
    assert night() == (list(range(10)), 10)


def test_key_sets_of_several_types_in_one_pass(spark):
    rows = spark.createDataFrame([(i % 7, f"s{i % 3}", None, i) for i in range(50)] + [(None, None, None, None)], "a int, b string, c int, d bigint")
    found = key_sets({c: rows.select(c) for c in rows.columns}, literal_keys=7)
    assert (found["a"].low, found["a"].high, sorted(found["a"].values)) == (0, 6, list(range(7)))
    assert sorted(found["b"].values) == ["s0", "s1", "s2"]
    assert (found["c"].values, found["c"].low) == ([], None)
    # Too many for literals: a frame and its range.
    assert (found["d"].values, found["d"].low, found["d"].high) == (None, 0, 49)
    assert scan_by_keys(rows, found["a"], "a").count() == 50
    assert scan_by_keys(rows, found["c"], "c").count() == 0
    assert scan_by_keys(rows, found["d"], "d").count() == 50


def test_an_only_batch_is_read_without_a_join(spark, rows, tmp_path):
    from chartloom.sources.keyed import DELETED, KeyedTable

    table = KeyedTable(spark, f"{tmp_path}/only", "k")
    marked = rows(f"k int, v string, {DELETED} boolean", (1, "a", False), (1, "b", None), (2, None, True))
    table.upsert(marked, "w", 0)
    got = table.read()
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (1, "b")]
    table.upsert(rows("k int, v string", (1, "c")))
    assert [(r.k, r.v) for r in table.read().collect()] == [(1, "c")]


def test_rows_of_many_keys_stay_dealt(rows, monkeypatch):
    from chartloom.operators.nesting import dealt
    from chartloom.sources import tables

    monkeypatch.setattr(tables, "BROADCAST_BYTES", 0)
    df, keys = rows("k int, v int", *[(i, i) for i in range(50)]), rows("k int", *[(i,) for i in range(20)])
    found = tables.scan_by_keys(df, keys, "k", literal_keys=5)
    assert dealt(found, "k") is found
    assert sorted(r.v for r in found.collect()) == list(range(20))
