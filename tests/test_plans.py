import json
from datetime import datetime

import pytest
from clinic import D, tables
from pyspark.sql import functions as F

from chartloom.operators.relational import union_all
from chartloom.plans import dimensions as dim
from chartloom.plans.encounters import encounter_documents
from chartloom.plans.lab_orders import lab_order_documents
from chartloom.plans.observations import obs_documents
from chartloom.plans.patients import patient_documents
from chartloom.plans.summaries import hiv_summary_documents, labs_documents, program_documents, vitals_documents
from chartloom.plans.target import as_json_columns, to_target


@pytest.fixture
def clinic(rows):
    return tables(rows)


def obs_of(t, **options):
    return obs_documents(t["obs"], dim.concepts(t), dim.drugs(t), **options)


def test_providers_have_names_or_blank(clinic):
    got = {r.provider_id: r.provider_name for r in dim.providers(clinic).collect()}
    assert got == {1: "Doc X Tor", 2: ""}


def test_names_prefer_the_preferred(clinic):
    got = {r.person_id: r.person_name for r in dim.person_names(clinic).collect()}
    assert got == {1: "Ann Lee", 2: "Only Second", 9: "Doc X Tor"}


def test_concepts_drop_retired_unless_asked(clinic):
    assert sorted(r.concept_id for r in dim.concepts(clinic).collect()) == [1, 2, 3, 4, 5, 7]
    assert dim.concepts(clinic, live_only=False).count() == 7


def test_observation_groups(clinic):
    docs = {r.obs_id: r for r in obs_of(clinic).collect()}
    assert sorted(docs) == [1, 2, 3, 4, 5, 12]
    assert [docs[i].value_type for i in (1, 2, 3, 4, 5)] == ["numeric", "coded", "drug", "datetime", None]
    assert [docs[i].value_not_coded for i in (1, 2, 3, 4)] == ["5.0", None, "ASPIRIN", str(D)]
    assert docs[2].value_coded_concept_name == "Concept 3" and docs[1].groupmembers is None
    members = docs[5].groupmembers
    assert [m.uuid for m in members] == ["b6", "b7", "b9"]
    assert members[0].display == "Concept 2 : Concept 3" and members[0].value.value == "word"
    assert json.loads(members[1].value.value) == {"display": "Concept 4", "uuid": "c4"}
    assert members[2].value.value == "{}" and members[2].obsGroup.uuid == "c2"


def copies(obs, n):
    """An observation n times, each with its own id and uuid."""
    numbered = obs.withColumn("obs_id", F.explode(F.sequence(F.lit(1000), F.lit(1000 + n - 1))))
    return numbered.withColumn("uuid", F.concat(F.lit("m"), (F.col("obs_id") - 1000).cast("string")))


def test_large_observation_group_is_whole(clinic):
    more = copies(clinic["obs"].where("obs_id = 6"), 50)
    t = {**clinic, "obs": clinic["obs"].unionByName(more)}
    got = obs_of(t, part_rows=5).where("obs_id = 5").collect()
    assert len(got) == 11 and all(len(r.groupmembers) <= 5 for r in got)
    assert sorted(m.uuid for r in got for m in r.groupmembers) == sorted(["b6", "b7", "b9", *[f"m{i}" for i in range(50)]])
    assert len({r.part for r in got}) == len(got) and {r.encounter_id for r in got} == {1}


def test_encounters(clinic):
    docs = {r.encounter_id: r for r in encounter_documents(clinic, obs_of(clinic), F.lit("now")).collect()}
    assert sorted(docs) == [1, 2]
    one, two = docs[1], docs[2]
    assert (two.obs, two.orders, two.encounterproviders) == ([], [], [])
    assert [p.uuid for p in one.encounterproviders] == ["ep1", "ep2"]
    assert one.encounterproviders[0].provider.display == "77-1 - Doc X Tor"
    assert [o.uuid for o in one.orders] == ["o1", "o2"] and one.orders[0].orderer.display == "77-1 Doc X Tor"
    assert [b.uuid for b in one.obs] == ["b12", "b1", "b2", "b3", "b4", "b5"]
    assert one.obs[2].value.type == "coded" and json.loads(one.obs[2].value.value)["uuid"] == "c3"
    assert one.obs[5].value is None and len(json.loads(one.obs[5].groupMembers)) == 3
    assert one.visit.display == f"Return @ Hill - {D}" and one.location.display == "Town"
    assert (one.person_id, one.doc_id, one.type, one.build_date, one.part) == (1, "1", "encounter", "now", 0)


def test_large_encounter_is_whole(clinic):
    """Small parts give the same providers, orders and observations, spread over several rows."""
    more = copies(clinic["obs"].where("obs_id = 1"), 40)
    t = {**clinic, "obs": clinic["obs"].unionByName(more)}

    def content(part_rows):
        found = encounter_documents(t, obs_of(t), part_rows=part_rows).collect()
        arrays = {a: sorted(x.uuid for r in found for x in r[a]) for a in ("obs", "orders", "encounterproviders")}
        assert len({(r.doc_id, r.part) for r in found}) == len(found)
        assert all(r.visit.uuid == "v1" and r.person_uuid == "p1" for r in found)
        return arrays, len(found)

    whole, parts = content(10_000), content(4)
    assert whole[0] == parts[0] and len(whole[0]["obs"]) == 46
    assert whole[1] == 2 and parts[1] > 8


def test_a_split_group_is_one_observation_of_its_encounter(clinic):
    more = copies(clinic["obs"].where("obs_id = 6"), 50)
    t = {**clinic, "obs": clinic["obs"].unionByName(more)}
    found = encounter_documents(t, obs_of(t, part_rows=5), part_rows=5).where("encounter_id = 1").collect()
    rows_ = sorted(found, key=lambda r: r.part)
    assert [r.part for r in rows_] == list(range(len(rows_)))
    assert all(len({x.uuid for x in r.obs}) == len(r.obs) for r in rows_)
    members = [m["uuid"] for r in rows_ for x in r.obs if x.uuid == "b5" for m in json.loads(x.groupMembers)]
    assert members == sorted(["b6", "b7", "b9", *[f"m{i}" for i in range(50)]])
    assert [x.uuid for r in rows_[:2] for x in r.obs] == ["b12", "b1", "b2", "b3", "b4", "b5"]


def test_target_form_and_recent_documents(clinic):
    docs = encounter_documents(clinic, obs_of(clinic), F.lit("now"))
    numbered = docs.where("encounter_id = 1").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(14))))
    many = numbered.withColumns(
        {
            "encounter_id": F.col("n"),
            "doc_id": F.col("n").cast("string"),
            "encounterdatetime": F.col("encounterdatetime") + F.make_dt_interval(F.floor(F.col("n") / 2)),
        }
    ).drop("n")
    parts = union_all(many, many.where("encounter_id in (3, 14)").withColumn("part", F.lit(2)))
    got = to_target("encounter", as_json_columns("encounter", parts))
    ids = sorted(r._id for r in got.collect())
    assert ids == sorted([f"encounter_{i}" for i in range(5, 15)] + ["encounter_14#2"])
    row = got.where("_id = 'encounter_14'").first()
    staged = docs.where("encounter_id = 1").first()
    assert [(o.uuid, o.orderNumber) for o in row.orders] == [(o.uuid, o.orderNumber) for o in staged.orders]
    assert all(isinstance(o.orderNumber, str) and o.type == "Test" for o in row.orders)
    assert row.encounterType.display == "Visit" and row.visit.visitType.name == "Return"
    assert {"encounterDatetime", "encounterType", "encounterProviders"} <= set(got.columns)


def test_lab_orders(clinic):
    docs = {r.order_id: r for r in lab_order_documents(clinic, F.lit("now")).collect()}
    assert sorted(docs) == [1, 2, 4]
    one = docs[1]
    assert (one.doc_id, one.identifiers, one.person_name) == ("lab_orders_1_1_o1", ["A", "B"], "Ann Lee")
    assert (one.obs_uuid, one.sample_drawn, one.sample_collection_date) == ("b12", "Concept 5", datetime(2020, 2, 1))
    assert (one.location_name, one.provider_name, one.conceptuuid, one.person_uuid) == ("Town", "Doc X Tor", "c1", "p1")
    assert docs[2].identifiers == [] and docs[2].obs_uuid is None
    four = docs[4]
    assert (four.doc_id, four.person_name, four.location_id, four.conceptuuid) == ("lab_orders_5_o4", None, None, None)
    target = to_target("lab_orders", lab_order_documents(clinic))
    assert {"conceptUuid", "orderNumber", "locationUuid", "_id"} <= set(target.columns)


VIEW = (
    "person_id int, person_uuid string, given_name string, middle_name string, family_name string, gender string, birthdate timestamp, "
    "dead boolean, death_date timestamp, cause_of_death string, birthdate_estimated boolean, person_attribute_value string, "
    "person_attribute_uuid string, person_attribute_voided boolean, person_attribute_type_name string, person_attribute_type_uuid string, "
    "identifier string, identifier_preferred boolean, identifier_location_name string, identifier_location_uuid string, "
    "identifier_type_name string, identifier_type_uuid string, "
    + ", ".join(
        f"person_address_{c} string"
        for c in "city_village longitude latitude country county_district 1 2 3 4 5 6 preferred".split()
    )
)


def view_row(person, attribute, identifier):
    address = ["Village", None, None, "Land", None, "a1", *[None] * 5, "1"]
    attributes = (f"v{attribute}", attribute, False, "phone", "pt") if attribute else (None,) * 5
    identifiers = (identifier, True, "Town", "l1", "number", "it") if identifier else (None,) * 6
    return (person, f"p{person}", "Ann", None, "Lee", "F", datetime(1980, 5, 5), False, None, None, None, *attributes, *identifiers, *address)


def test_patients(rows):
    view = rows(VIEW, *[view_row(1, a, i) for a in ("x", "y") for i in ("A", "B", "C")], view_row(2, None, None))
    as_of = F.to_date(F.lit("2020-01-01"))
    docs = {r.person_id: r for r in patient_documents(view, as_of, F.lit("now")).collect()}
    one, two = docs[1].patient, docs[2].patient
    assert one.display == "Ann  Lee" and one.person.age == 40 and one.person.causeOfDeath == ""
    assert [a.display for a in one.person.attributes] == ["phone = vx", "phone = vy"]
    assert [i.identifier for i in one.identifiers] == ["A", "B", "C"]
    assert one.preferredAddress.country == "Land" and one.preferredAddress.address2 == ""
    assert (two.person.attributes, two.identifiers) == ([], [])
    literal = patient_documents(view.where("person_id = 2"), as_of, keep_empty=True).first().patient
    assert literal.person.attributes[0].display == " = " and len(literal.identifiers) == 1
    parts = patient_documents(view, as_of, part_rows=2).where("person_id = 1").collect()
    assert sorted(i.identifier for r in parts for i in r.patient.identifiers) == ["A", "B", "C"]
    assert all(r.patient.display == "Ann  Lee" for r in parts)
    staged = as_json_columns("patient", patient_documents(view, as_of))
    again = to_target("patient", staged).where("_id = 'patient_1'").first()
    assert again.patient.identifiers == one.identifiers and again.patient.person.birthdate == datetime(1980, 5, 5)


def test_row_documents(rows):
    summary = rows(
        "person_id int, encounter_id int, cur_arv_meds string, arv_first_regimen string, cur_arv_meds_strict string, prev_arv_meds string",
        (1, 2, "625 ## 1", None, "", "628"),
    )
    got = hiv_summary_documents(summary, F.lit("now")).first()
    assert (got.doc_id, got.type) == ("hivsummary_1_2", "hiv_summary")
    assert (got.cur_arv_meds, got.arv_first_regimen, got.cur_arv_meds_strict, got.prev_arv_meds) == ("STAVUDINE,", None, "", "LAMIVUDINE,")
    vital = vitals_documents(rows("person_id int, encounter_id int", (1, None))).first()
    assert vital.doc_id == "vitals_1" and vital.build_date is not None
    program = program_documents(
        rows("uuid string, location_name string, location_uuid string, program_name string, program_uuid string", ("u", "L", "l", "P", "p"))
    )
    row = program.first()
    assert (row.doc_id, row.location.name, row.program.uuid) == ("u", "L", "p")
    assert not {"program_name", "location_uuid", "location_name"} & set(program.columns) and row.program_uuid == "p"


@pytest.mark.parametrize("by", [("person_id",), ()])
def test_labs_take_the_regimen_of_the_day(rows, by):
    t0, t1 = datetime(2020, 1, 1, 8), datetime(2020, 1, 1, 9)
    summary = rows(
        "person_id int, encounter_id int, encounter_datetime timestamp, is_clinical_encounter int, cur_arv_meds string",
        (1, 10, t0, 1, "625"),
        (1, 11, t1, 1, "628"),
        (2, 12, t1, 1, "633"),
        (2, 13, t0, 0, "631"),
    )
    labs = rows(
        "person_id int, encounter_id int, uuid string, test_datetime timestamp",
        (1, 1, "p1", t0),
        (1, 2, "p1", t1),
        (2, 3, "p2", t0),
        (2, 4, "p2", t1),
    )
    got = labs_documents(labs, rows("encounter_id int, location_id int", (1, 5)), summary, by).collect()
    meds = {r.encounter_id: r.cur_arv_meds for r in got}
    if by:
        assert meds == {1: "STAVUDINE,", 2: None, 3: None, 4: "EFAVIRENZ,"}
    else:
        assert meds == {1: "STAVUDINE,", 2: None, 3: "STAVUDINE,", 4: None}
    assert {r.encounter_id: r.location_id for r in got}[1] == 5
    assert got[0].doc_id.startswith("labs_") and got[0].person_uuid


def test_metadata(clinic, rows):
    t = {**clinic, "program": rows("name string, uuid string, concept_id int", ("HIV", "g1", 1), ("X", "g2", 77))}
    docs = {r._id: r for r in dim.metadata_documents(t, rows("_id string, _rev string", ("l1", "4-x"))).collect()}
    assert sorted(docs) == ["g1", "l1", "l2"]
    assert docs["l1"]._rev == "4-x" and docs["l2"]._rev is None and docs["g1"].concept.uuid == "c1"
    assert docs["l1"].type == "location" and docs["g1"].type == "program"


def test_cut_documents_join_whole_sides_and_write_nothing_down(clinic, monkeypatch):
    from chartloom.operators import nesting
    from chartloom.plans import encounters

    made = []
    for module in (nesting, encounters):
        monkeypatch.setattr(module, "written", lambda df, label, own=nesting.written: made.append(label) or own(df, label))
    whole = {r.encounter_id: r for r in encounter_documents(clinic, obs_of(clinic)).collect()}
    parts = encounter_documents(clinic, obs_of(clinic), part_rows=1).collect()
    assert made == []
    for key, doc in whole.items():
        own = sorted((r for r in parts if r.encounter_id == key), key=lambda r: r.part)
        assert [r.part for r in own] == list(range(max(1, len(doc.encounterproviders), len(doc.orders), len(doc.obs))))
        for name in ("encounterproviders", "orders", "obs"):
            assert [x for r in own for x in r[name]] == doc[name]


def test_rows_are_dealt_by_encounter_before_texts_are_looked_up(clinic):
    docs = encounter_documents(clinic, obs_of(clinic, by="encounter_id"))
    lines = docs._jdf.queryExecution().optimizedPlan().toString().split("\n")
    moved = [lines[i + 1] for i, line in enumerate(lines) if "RepartitionByExpression [encounter_id" in line]
    assert len(moved) == 4
    assert not any(text in m for m in moved for text in ("concept_name", "provider_name", "form_name", "visit_type_name"))


@pytest.mark.parametrize("key_bytes", [16, 10**9])
def test_members_of_large_groups_meet_their_roots(clinic, monkeypatch, key_bytes):
    from chartloom.plans import observations

    few = sorted(obs_of(clinic).collect(), key=lambda r: r.obs_id)
    monkeypatch.setattr(observations, "BROADCAST_BYTES", 100)
    monkeypatch.setattr(observations, "KEY_BYTES", key_bytes)
    large = obs_of(clinic, by="encounter_id").select(*few[0].asDict())
    assert sorted(large.collect(), key=lambda r: r.obs_id) == few


def test_sides_of_large_dictionaries_are_written_as_they_are_dealt(clinic, spark, monkeypatch):
    """With large dictionaries all sides of the documents are read as they were dealt, and the latest documents of each person are found by their keys."""
    from chartloom.operators.relational import Dimension
    from chartloom.plans import encounters, observations

    text = lambda docs: sorted(map(str, docs.collect()))
    made = lambda: encounter_documents(clinic, obs_of(clinic, by="encounter_id"), F.lit("now"), 1)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    usual = text(made())
    for module in (encounters, observations):
        monkeypatch.setattr(module, "measured", lambda df: Dimension(df, False))
    docs = made()
    assert len({word for word in plan(docs).split() if "chartloom_" in word}) == 4
    assert "RepartitionByExpression [encounter_id" not in plan(docs)
    assert text(docs) == usual
    latest = to_target("encounter", as_json_columns("encounter", docs))
    assert "LeftSemi" in plan(latest) and latest.count() == len(usual)
    # Documents that share a key are told apart by the rows themselves.
    twice = to_target("encounter", as_json_columns("encounter", docs.unionByName(docs)))
    assert "row_number" in plan(twice)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("chartloom")]
