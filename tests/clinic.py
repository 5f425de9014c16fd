"""A small clinic with every special case the documents know."""

from datetime import datetime

D = datetime(2020, 3, 1, 9)


def tables(rows):
    return {
        "form": rows("form_id int, uuid string, name string", (1, "f1", "Intake")),
        "encounter_type": rows("encounter_type_id int, uuid string, name string", (1, "t1", "Visit")),
        "location": rows("location_id int, uuid string, name string", (1, "l1", "Town"), (2, "l2", "Hill")),
        "visit_type": rows("visit_type_id int, uuid string, name string", (1, "vt1", "Return")),
        "order_type": rows("order_type_id int, name string", (1, "Test")),
        "visit": rows(
            "visit_id int, visit_type_id int, location_id int, uuid string, date_started timestamp, date_stopped timestamp",
            (1, 1, 2, "v1", D, None),
        ),
        "person": rows("person_id int, uuid string", (1, "p1"), (2, "p2")),
        "patient": rows("patient_id int", (1,), (2,)),
        "person_name": rows(
            "person_id int, given_name string, middle_name string, family_name string, uuid string, preferred boolean",
            (1, "Ann", None, "Lee", "n1", True),
            (1, "Old", None, "Name", "n0", False),
            (9, "Doc", "X", "Tor", "n9", True),
            (2, "Only", None, "Second", "n2", False),
        ),
        "provider": rows("provider_id int, person_id int, uuid string, identifier string", (1, 9, "pr1", "77-1"), (2, 8, "pr2", None)),
        "encounter_provider": rows("uuid string, encounter_id int, provider_id int", ("ep1", 1, 1), ("ep2", 1, 2), ("ep1", 1, 1), ("ep3", 1, 99)),
        "concept": rows(
            "concept_id int, uuid string, retired boolean",
            *[(i, f"c{i}", False) for i in range(1, 6)],
            (6, "c6", True),
            (7, "c7", None),
        ),
        "concept_name": rows(
            "concept_id int, name string, locale_preferred boolean",
            *[(i, f"Concept {i}", True) for i in range(1, 8)],
            (1, "Other", False),
        ),
        "drug": rows("drug_id int, name string", (1, "ASPIRIN")),
        "encounter": rows(
            "encounter_id int, patient_id int, form_id int, location_id int, visit_id int, encounter_type int, "
            "encounter_datetime timestamp, uuid string, voided boolean",
            (1, 1, 1, 1, 1, 1, D, "e1", False),
            (2, 1, 1, 1, 1, 1, D, "e2", None),
            (3, 1, 1, 1, 1, 1, D, "e3", True),
            (4, 1, 1, 1, 99, 1, D, "e4", False),
        ),
        "orders": rows(
            "order_id int, uuid string, encounter_id int, patient_id int, concept_id int, orderer int, order_action string, "
            "date_activated timestamp, date_created timestamp, urgency string, order_type_id int, order_number string, voided boolean",
            (1, "o1", 1, 1, 1, 1, "NEW", D, D, "STAT", 1, "ORD-1", False),
            (2, "o2", 1, 2, 2, 1, "NEW", D, D, "STAT", 1, "12", None),
            (3, "o3", 1, 1, 1, 1, "NEW", D, D, "STAT", 1, "13", True),
            (4, "o4", None, 5, 6, None, "NEW", D, D, "STAT", 1, "14", False),
        ),
        "obs": rows(
            "obs_id int, person_id int, concept_id int, encounter_id int, obs_group_id int, order_id int, value_coded int, "
            "value_drug int, value_text string, value_numeric double, value_datetime timestamp, obs_datetime timestamp, uuid string, voided boolean",
            (1, 1, 1, 1, None, 1, None, None, None, 5.0, None, D, "b1", False),
            (2, 1, 1, 1, None, None, 3, None, None, None, None, D, "b2", None),
            (3, 1, 1, 1, None, None, None, 1, None, None, None, D, "b3", False),
            (4, 1, 1, 1, None, None, None, None, None, None, D, D, "b4", False),
            (5, 1, 2, 1, None, None, None, None, None, None, None, D, "b5", False),
            (6, 1, 3, 1, 5, None, None, None, "word", None, None, D, "b6", False),
            (7, 1, 4, 1, 5, None, 4, None, None, None, None, D, "b7", False),
            (8, 1, 6, 1, 5, None, None, None, "retired question", None, None, D, "b8", False),
            (9, 1, 4, 1, 5, None, None, None, None, None, None, D, "b9", False),
            (10, 1, 1, 1, None, None, None, None, "gone", None, None, D, "b10", True),
            (11, 1, 3, 1, 6, None, None, None, "child of a member", None, None, D, "b11", False),
            (12, 1, 7, 1, None, 1, 5, None, None, None, None, datetime(2020, 2, 1), "b12", False),
        ),
        "patient_identifier": rows("patient_id int, identifier string", (1, "A"), (1, "B"), (1, "A")),
    }
