from datetime import datetime

from pyspark.sql import functions as F

from chartloom.operators.sync import classify, cohort, cohorts, joiners, leavers, stale_parts, tombstones
from chartloom.plans.rebuild import initial_load, nightly_delete, nightly_upsert, rebuild_all
from chartloom.sources.documents import read_manifest
from chartloom.sources.staging import read_staging

D1, D2 = datetime(2020, 1, 1), datetime(2020, 1, 2)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_document_has_one_status(rows):
    docs = rows("doc_id string, build_date timestamp", ("new", D1), ("same", D1), ("changed", D2), ("undated", D2))
    manifest = rows(
        "_id string, _rev string, build_date timestamp",
        ("same", "1-a", D1),
        ("changed", "2-b", D1),
        ("undated", "3-c", None),
        ("other", "4-d", D1),
    )
    got = values(classify(docs, manifest).select("doc_id", "status", "_rev"))
    assert got == [("changed", "update", "2-b"), ("new", "insert", None), ("same", "unchanged", "1-a"), ("undated", "unchanged", "3-c")]


def summary(rows):
    return rows(
        "person_id int, location_id int, rtc_date timestamp",
        (1, 1, datetime(2020, 1, 3)),
        (1, 1, datetime(2020, 1, 5)),
        (2, 1, datetime(2020, 1, 20)),
        (3, 2, datetime(2020, 1, 3)),
        (4, 1, datetime(2020, 2, 2)),
        (5, 1, datetime(2020, 2, 3)),
        (6, 1, None),
    )


def day(text):
    return F.to_date(F.lit(text))


def test_cohorts(rows):
    df = summary(rows)
    assert values(cohort(df, day("2020-01-31"), 1)) == [(1,), (2,), (4,)]
    assert values(cohorts(df, day("2020-01-31"))) == [(1, 1), (1, 2), (1, 4), (2, 3)]
    today, before = cohort(df, day("2020-02-03"), 1), cohort(df, day("2020-01-31"), 1)
    assert values(leavers(before, today)) == [(1,)]
    assert values(joiners(today, before)) == [(5,)]


def test_removals(rows):
    manifest = rows("_id string, _rev string, person_id int", ("a", "1", 1), ("b", "1", 2), ("b#2", "1", 2), ("b#5", "1", 2), ("c#1", "1", 3))
    assert values(tombstones(manifest, rows("person_id int", (1,), (9,)))) == [(1, "a", "1", True)]
    docs = rows("_id string", ("b",), ("b#2",), ("a",))
    assert values(stale_parts(manifest, docs).select("_id", "_deleted")) == [("b#5", True)]


def test_first_load_takes_those_seen_at_the_place(rows):
    staged = rows(
        "doc_id string, person_id int, location_id int",
        ("x1", 1, 7),
        ("x2", 1, 8),
        ("x3", 2, 8),
        ("x4", 3, 7),
    )
    members = rows("person_id int", (1,), (2,))
    assert values(initial_load("labs", staged, members, 7).select("_id")) == [("x1",), ("x2",)]
    patients = rows("doc_id string, person_id int, patient string", ("1", 1, "{}"), ("3", 3, "{}"))
    assert values(initial_load("patient", patients, members, 7).select("_id")) == [("patient_1",)]


def test_nights(spark, rows, tmp_path):
    staging, target = str(tmp_path / "staging"), str(tmp_path / "target")
    visits = summary(rows)

    def docs(parts, date):
        return rows(
            "doc_id string, part int, person_id int, build_date timestamp",
            *[(f"d{p}", n, p, date) for p in range(1, 7) for n in range(parts)],
        )

    def stored():
        return {(r.db, r._id, r.build_date) for r in read_manifest(spark, target).collect()}

    rebuild_all({"docs": lambda: docs(2, D1)}, staging)
    assert read_staging(spark, staging, "docs").count() == 12
    nightly_upsert(spark, staging, target, visits, day("2020-01-31"), ["docs"])
    first = {("location-1", f"d{p}{s}", D1) for p in (1, 2, 4) for s in ("", "#1")}
    first |= {("location-2", f"d3{s}", D1) for s in ("", "#1")}
    assert stored() == first
    nightly_upsert(spark, staging, target, visits, day("2020-01-31"), ["docs"])
    assert stored() == first
    rebuild_all({"docs": lambda: docs(1, D2)}, staging)
    nightly_upsert(spark, staging, target, visits, day("2020-02-03"), ["docs"])
    nightly_delete(spark, target, visits, day("2020-02-03"), day("2020-01-31"))
    assert stored() == {("location-1", f"d{k}", D2) for k in (2, 4, 5)}
