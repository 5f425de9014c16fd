"""The jobs, one after another, on a folder of source tables."""

import json
from datetime import datetime

from clinic import D, tables
from test_plans import VIEW, view_row

from chartloom import jobs
from chartloom.sources.documents import read_manifest
from chartloom.sources.staging import read_staging


def test_rebuild_load_night_and_stream(spark, rows, tmp_path):
    source, staging, target = (str(tmp_path / n) for n in ("source", "staging", "target"))
    summary = rows(
        "person_id int, encounter_id int, location_id int, encounter_datetime timestamp, rtc_date timestamp, is_clinical_encounter int, "
        "cur_arv_meds string, arv_first_regimen string, cur_arv_meds_strict string, prev_arv_meds string",
        (1, 1, 1, D, datetime(2020, 3, 10), 1, "625", None, None, None),
        (2, 9, 2, D, datetime(2020, 1, 1), 1, None, None, None, None),
    )
    flat = {
        **tables(rows),
        "flat_hiv_summary": summary,
        "flat_vitals": rows("person_id int, encounter_id int, location_id int, encounter_datetime timestamp, weight double", (1, 1, 1, D, 70.0)),
        "flat_labs_and_imaging": rows("person_id int, encounter_id int, uuid string, test_datetime timestamp", (1, 1, "p1", D)),
        "patient_view": rows(VIEW, view_row(1, "x", "A"), view_row(2, None, None)),
        "program_enrollment_view": rows(
            "person_id int, patient_program_id int, location_id int, uuid string, location_name string, location_uuid string, program_name string, program_uuid string",
            (1, 4, 1, "g", "L", "l", "P", "p"),
        ),
        "program": rows("name string, uuid string, concept_id int", ("HIV", "g1", 1)),
    }
    for name, df in flat.items():
        df.write.parquet(f"{source}/{name}.parquet")
    common = ["--source", source, "--staging", staging, "--date", "2020-03-01"]
    jobs.main(["rebuild", *common])
    counts = {t: read_staging(spark, staging, t).count() for t in jobs.SYNCED}
    assert counts == {"patient": 2, "encounter": 2, "vitals": 1, "hiv_summary": 2, "program_enrollment": 1, "lab_orders": 3, "labs": 1}

    jobs.main(["metadata", "--source", source, "--target", target])
    jobs.main(["first-load", *common, "--target", target, "--location", "1", "--tables", "patient", "vitals"])

    def stored(db):
        return sorted(r._id for r in read_manifest(spark, target, db).collect())

    assert stored("metadata") == ["g1", "l1", "l2"] and stored("location-1") == []
    later = [*common[:-1], "2020-03-09", "--target", target]
    jobs.main(["first-load", *later, "--location", "1", "--tables", "patient", "vitals"])
    assert stored("location-1") == ["patient_1", "vitals_1_1"]
    jobs.main(["nightly", *later, "--tables", "hiv_summary", "lab_orders"])
    assert stored("location-1") == ["hivsummary_1_1", "lab_orders_1_1_o1", "patient_1", "vitals_1_1"]

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    after = {"person_id": 1, "encounter_id": 5, "encounter_datetime": 1583744400000, "weight": "71"}
    event = {"schema": {"name": "x.vitals_2.Envelope"}, "payload": {"after": after, "ts_ms": 1}}
    (inbox / "a.txt").write_text(json.dumps(event) + "\n")
    jobs.main(["stream", "vitals", *common, "--checkpoint", str(tmp_path / "checkpoint"), "--inbox", str(inbox), "--once"])
    assert sorted(r.doc_id for r in read_staging(spark, staging, "vitals").collect()) == ["vitals_1_1", "vitals_1_5"]
