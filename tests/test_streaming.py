import json
from datetime import datetime
from pathlib import Path

import pytest
from clinic import tables
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.plans.summaries import hiv_summary_documents, labs_documents, vitals_documents
from chartloom.sources.changes import POSITION, SOURCE, decode, read_file_changes, typed_rows
from chartloom.sources.documents import read_manifest
from chartloom.sources.keyed import KeyedTable
from chartloom.sources.staging import read_staging
from chartloom.streaming.changes import after_image, batch_keys, last_changes, route
from chartloom.streaming.jobs import (
    Staging,
    direct,
    encounters_of,
    lab_orders_of,
    labs_of,
    programs_of,
    rebuild,
    run_stream,
    staged_then_sync,
)
from chartloom.streaming.parse import parse_encounters, parse_hiv_summary, parse_vitals


def event(source, after, ts):
    return json.dumps({"schema": {"name": source}, "payload": {"before": None, "after": after, "op": "u", "ts_ms": ts}})


def vital(person, encounter, weight, ts, **more):
    after = {"person_id": person, "encounter_id": encounter, "encounter_datetime": 1577836800000 + ts, "weight": weight, **more}
    return event("clinic.vitals.Envelope", after, ts)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, *lines):
        (folder / f"{name}.txt").write_text("".join(line + "\n" for line in lines))
        return str(folder)

    return put


def texts(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)


def test_decode_and_route(spark):
    df = texts(
        spark,
        vital(1, 2, "70", 5),
        event("clinic.vitals.Envelope", None, 6),
        event("clinic.vitals_old.Envelope", {"person_id": 3}, 7),
        "{broken",
    )
    events = decode(df, schemas.VITALS_CHANGE)
    assert [(r[SOURCE], r[POSITION] and r[POSITION].ts_ms) for r in events.collect()] == [
        ("clinic.vitals.Envelope", 5),
        ("clinic.vitals.Envelope", 6),
        ("clinic.vitals_old.Envelope", 7),
        (None, None),
    ]
    assert route(events, "vitals", exact=False).count() == 3
    assert [r.person_id for r in after_image(df, schemas.VITALS_CHANGE, "clinic.vitals.Envelope").collect()] == [1]
    assert [r.person_id for r in after_image(df, schemas.VITALS_CHANGE).collect()] == [1, 3]
    plain = typed_rows(texts(spark, '{"person_id": 4}'), schemas.PERSON_CHANGE)
    assert [r.person_id for r in plain.collect()] == [4]


def test_last_change_and_keys(spark):
    df = texts(spark, vital(1, 2, "70", 5), vital(1, 2, "71", 9), vital(1, 2, "72", 7), vital(2, None, "5", 1))
    rows = after_image(df, schemas.VITALS_CHANGE)
    last = {(r.person_id, r.encounter_id): r.weight for r in last_changes(rows, ["person_id", "encounter_id"]).collect()}
    assert last == {(1, 2): "71", (2, None): "5"}
    keys = batch_keys(rows, {"id": "encounter_id", "person_id": "person_id"}, null_as=0)
    assert sorted(r.id for r in keys["id"].collect()) == [0, 2]
    assert keys["person_id"].count() == 2


def test_parsed_rows(spark):
    row = parse_vitals(after_image(texts(spark, vital(1, 2, "70.5", 1500, height="tall", pulse="60")), schemas.VITALS_CHANGE)).first()
    assert (row.weight, row.height, row.pulse, row.encounter_datetime) == (70.5, None, "60", datetime(2020, 1, 1, 0, 0, 1))
    encounter = event("e", {"encounter_id": 1, "voided": 0, "encounter_datetime": "1577836800000"}, 1)
    row = parse_encounters(after_image(texts(spark, encounter), schemas.ENCOUNTER_CHANGE)).first()
    assert (row.voided, row.encounter_datetime, row.date_voided) == (False, datetime(2020, 1, 1), None)
    summary = event("h", {"person_id": 1, "encounter_id": 2, "rtc_date": 1577836800000, "vl_1_date": 1577836800, "vl_1": 2.5, "cur_arv_meds": "625", "date_created": "2020-01-01T00:00:00", "edd": 1000000000}, 1)
    row = hiv_summary_documents(parse_hiv_summary(after_image(texts(spark, summary), schemas.HIV_SUMMARY_CHANGE))).first()
    assert row.rtc_date == row.vl_1_date == row.date_created == datetime(2020, 1, 1)
    assert (row.edd, row.vl_1, row.cur_arv_meds, row.doc_id) == (1000000000, 2.5, "STAVUDINE,", "hivsummary_1_2")


def test_direct_stream_restarts_and_counts(spark, inbox, tmp_path):
    staging = Staging(str(tmp_path / "staging"), "vitals", "vitals-job")
    job = direct(staging, ["person_id", "encounter_id"], lambda r: vitals_documents(parse_vitals(r), F.lit("now")))
    seen = []

    def run(checkpoint="checkpoint"):
        stream = after_image(read_file_changes(spark, str(tmp_path / "inbox"), 1), schemas.VITALS_CHANGE, "clinic.vitals.Envelope")
        query = run_stream(stream, job, str(tmp_path / checkpoint), None)
        query.awaitTermination()
        seen.extend(p.observedMetrics["changes"] for p in query.recentProgress if "changes" in p.observedMetrics)
        return {r.doc_id: r.weight for r in read_staging(spark, staging.root, "vitals").collect()}

    inbox("a", vital(1, 2, "70", 1), vital(1, 2, "71", 2), event("clinic.vitals.Envelope", None, 3), "{broken", event("x", {}, 4))
    assert run() == {"vitals_1_2": 71.0}
    assert sum(m["seen"] for m in seen) == 3 and sum(m["skipped"] for m in seen) == 1
    inbox("b", vital(1, 2, "72", 5), vital(2, 2, "50", 6))
    want = {"vitals_1_2": 72.0, "vitals_2_2": 50.0}
    assert run() == want
    assert run() == want
    # A batch that is processed again, after a failure before its checkpoint, changes nothing.
    assert run("another-checkpoint") == want


def test_a_new_checkpoint_is_a_new_writer(spark, inbox, tmp_path):
    staging = Staging(str(tmp_path / "staging"), "vitals")
    job = direct(staging, ["person_id", "encounter_id"], lambda rows: vitals_documents(parse_vitals(rows)))
    for name in ("first", "second"):
        folder = str(tmp_path / name)
        weight = "70" if name == "first" else "71"
        spark.createDataFrame([(vital(1, 2, weight, 1),)], "value string").coalesce(1).write.text(folder)
        stream = after_image(read_file_changes(spark, folder), schemas.VITALS_CHANGE, "clinic.vitals.Envelope")
        run_stream(stream, job, str(tmp_path / f"checkpoint-{name}"), None).awaitTermination()
    assert {r.doc_id: r.weight for r in read_staging(spark, staging.root, "vitals").collect()} == {"vitals_1_2": 71.0}


def encounter_event(ts, encounter_id=1, voided=0, **more):
    after = {
        "encounter_id": encounter_id,
        "patient_id": 1,
        "form_id": 1,
        "location_id": 1,
        "visit_id": 1,
        "encounter_type": 1,
        "encounter_datetime": "1583053200000",
        "voided": voided,
        "uuid": f"e{encounter_id}",
        **more,
    }
    return event("clinic.encounter.Envelope", after, ts)


def test_voided_encounters_leave_staging(spark, rows, inbox, tmp_path):
    staging = Staging(str(tmp_path / "staging"), "encounter")
    job = rebuild(staging, encounters_of(tables(rows), parse_encounters))

    def run(name, *lines):
        folder = inbox(name, *lines)
        stream = after_image(read_file_changes(spark, folder), schemas.ENCOUNTER_CHANGE, "clinic.encounter.Envelope")
        run_stream(stream, job, str(tmp_path / "checkpoint"), None).awaitTermination()
        return {r.encounter_id: r for r in read_staging(spark, staging.root, "encounter").collect()}

    docs = run("a", encounter_event(1), encounter_event(2, 2), encounter_event(3, 4, visit_id=None))
    assert sorted(docs) == [1, 2]
    assert [b.uuid for b in docs[1].obs] == ["b12", "b1", "b2", "b3", "b4", "b5"] and docs[2].obs == []
    assert len(docs[1].orders) == 2 and len(docs[1].encounterproviders) == 2
    assert sorted(run("b", encounter_event(9, 1, 1), encounter_event(8, 1, 0))) == [2]


def test_rebuild_functions_take_only_what_changed(spark, rows):
    clinic = tables(rows)
    batch = rows("order_id int, patient_id int, orderer int, encounter_id int", (1, 1, 1, 1), (3, 1, 1, 1))
    got = lab_orders_of(clinic)(batch).collect()
    assert [(r.order_id, r.identifiers, r.location_name, r.obs_uuid) for r in got] == [(1, ["A", "B"], "Town", "b12")]
    view = rows("patient_program_id int, uuid string, location_name string, location_uuid string, program_name string, program_uuid string", (1, "a", "L", "l", "P", "p"), (2, "b", "L", "l", "P", "p"))
    assert [r.doc_id for r in programs_of(view)(rows("patient_program_id int", (2,))).collect()] == ["b"]
    labs = rows("person_id int, encounter_id int, uuid string, test_datetime timestamp", (1, 1, "p", None), (1, 2, "p", None))
    summary = rows("person_id int, encounter_id int, encounter_datetime timestamp, is_clinical_encounter int, cur_arv_meds string")
    build = labs_of(labs, rows("encounter_id int, location_id int", (2, 3)), summary)
    assert [(r.encounter_id, r.location_id) for r in build(rows("encounter_id int", (2,))).collect()] == [(2, 3)]


def test_streamed_labs_have_the_regimen_of_the_day(rows):
    """The regimen in force may come from an encounter that is not in the batch."""
    at = datetime(2020, 1, 1, 8)
    labs = rows("person_id int, encounter_id int, test_datetime timestamp, uuid string", (1, 5, at, "u5"), (1, 4, at, "u4"), (2, 6, at, "u6"))
    summary = rows(
        "person_id int, encounter_id int, encounter_datetime timestamp, is_clinical_encounter int, cur_arv_meds string",
        (1, 4, at, 1, "625"), (1, 5, at, 1, "628"), (2, 6, at, 1, "633"),
    )
    places = rows("encounter_id int, location_id int", (5, 1))
    whole = {r.encounter_id: r.cur_arv_meds for r in labs_documents(labs, places, summary).collect()}
    batch = labs_of(labs, places, summary)(rows("encounter_id int", (5,))).collect()
    assert {r.encounter_id: r.cur_arv_meds for r in batch} == {5: whole[5]} and whole[5]


def test_staged_then_synced(spark, rows, inbox, tmp_path):
    staging, target = Staging(str(tmp_path / "staging"), "vitals"), str(tmp_path / "target")
    visits = rows(
        "person_id int, location_id int, rtc_date timestamp",
        (1, 7, datetime(2020, 1, 1)),
        (1, 8, datetime(2020, 1, 1)),
        (2, 7, datetime(2019, 1, 1)),
    )
    build = iter([datetime(2020, 1, 1), datetime(2020, 1, 2)])
    stage = direct(staging, ["person_id", "encounter_id"], lambda r: vitals_documents(parse_vitals(r), F.lit(next(build))))
    job = staged_then_sync(stage, staging, target, visits, lambda: F.to_date(F.lit("2020-01-01")))

    def run(name, *lines):
        stream = after_image(read_file_changes(spark, inbox(name, *lines)), schemas.VITALS_CHANGE)
        run_stream(stream, job, str(tmp_path / "checkpoint"), None).awaitTermination()
        return {(r.db, r._id, r._rev) for r in read_manifest(spark, target).collect()}

    first = run("a", vital(1, 1, "70", 1), vital(2, 1, "50", 2))
    assert first == {("location-7", "vitals_1_1", None), ("location-8", "vitals_1_1", None)}
    second = run("b", *[vital(1, e, "71", 10 + 86_400_000 * e) for e in range(2, 12)])
    assert {i for _, i, _ in second} == {f"vitals_1_{e}" for e in range(1, 12)}


def test_positions_over_topics(spark):
    lines = [(vital(1, 2, "70", 5), "b", 0, 1), (vital(1, 2, "71", 5), "a", 1, 9), (vital(1, 2, "72", 4), "z", 3, 99)]
    df = spark.createDataFrame(lines, "value string, topic string, partition int, offset long")
    rows = after_image(df, schemas.VITALS_CHANGE)
    assert [r.weight for r in last_changes(rows, "person_id").collect()] == ["70"]


def test_an_older_change_of_a_later_batch(spark, inbox, tmp_path):
    staging = Staging(str(tmp_path / "staging"), "vitals")
    job = direct(staging, ["person_id", "encounter_id"], lambda r: vitals_documents(parse_vitals(r), F.lit(datetime(2020, 1, 1))))

    def run(name, checkpoint, *lines):
        stream = after_image(read_file_changes(spark, inbox(name, *lines)), schemas.VITALS_CHANGE)
        run_stream(stream, job, str(tmp_path / checkpoint), None).awaitTermination()
        return {r.encounter_id: r.weight for r in staging.open(spark).read().collect()}

    assert run("a", "c", vital(1, 1, "70", 20), vital(1, 2, "50", 20)) == {1: 70.0, 2: 50.0}
    assert run("b", "c", vital(1, 1, "60", 10), vital(1, 2, "51", 30)) == {1: 70.0, 2: 51.0}
    staging.open(spark).compact()
    # A new checkpoint reads all from the start.
    assert run("c", "new", vital(1, 3, "1", 1)) == {1: 70.0, 2: 51.0, 3: 1.0}


def test_batches_leave_no_folders(spark, inbox, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("chartloom.sources.keyed.COMPACT_AFTER", 2)
    monkeypatch.setattr("chartloom.sources.keyed.KeyedTable.vacuum", lambda self, seconds=0, f=KeyedTable.vacuum: f(self, -60))
    staging, target = Staging(str(tmp_path / "staging"), "vitals"), str(tmp_path / "target")
    visits = rows("person_id int, location_id int, rtc_date timestamp", (1, 7, datetime(2020, 1, 1)))
    stage = direct(staging, ["person_id", "encounter_id"], lambda r: vitals_documents(parse_vitals(r), F.lit(datetime(2020, 1, 1))))
    job = staged_then_sync(stage, staging, target, visits, lambda: F.to_date(F.lit("2020-01-01")))
    work = Path(spark.conf.get("spark.checkpoint.dir"))
    folders, before = [], len(list(work.iterdir()))
    for k in range(7):
        stream = after_image(read_file_changes(spark, inbox(f"f{k}", vital(1, k, "70", k))), schemas.VITALS_CHANGE)
        run_stream(stream, job, str(tmp_path / "checkpoint"), None).awaitTermination()
        folders.append(len(list((tmp_path / "staging/vitals/data").iterdir())) + len(list((tmp_path / "target/data").iterdir())))
    assert len(list(work.iterdir())) == before
    assert max(folders[3:]) <= 8
    assert staging.open(spark).read().count() == 7
