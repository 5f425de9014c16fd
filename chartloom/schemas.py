"""Declared row and document schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from chartloom.columns import row_type

NAME_UUID = row_type(name="string", uuid="string")
UUID_DISPLAY = row_type(uuid="string", display="string")

# -- documents --------------------------------------------------------------------------------

VISIT = row_type(
    uuid="string",
    dateStarted="timestamp",
    dateStopped="timestamp",
    visitType=NAME_UUID,
    location=NAME_UUID,
    display="string",
)

ENCOUNTER_PROVIDERS = T.ArrayType(row_type(uuid="string", display="string", provider=UUID_DISPLAY))

ORDERS = T.ArrayType(
    row_type(
        uuid="string",
        orderNumber="string",
        concept=UUID_DISPLAY,
        orderer=UUID_DISPLAY,
        action="string",
        dateActivated="timestamp",
        dateCreated="timestamp",
        urgency="string",
        type="string",
    )
)

OBSERVATIONS = T.ArrayType(
    row_type(
        uuid="string",
        obsDatetime="timestamp",
        concept=row_type(uuid="string", name=row_type(display="string")),
        value=row_type(type="string", value="string"),
        groupMembers="string",
    )
)

GROUP_MEMBERS = T.ArrayType(
    row_type(
        uuid="string",
        obsDatetime="timestamp",
        concept=UUID_DISPLAY,
        display="string",
        obsGroup=row_type(display="string", uuid="string"),
        value=row_type(value="string", type="string"),
    )
)

PATIENT = row_type(
    uuid="string",
    display="string",
    person=row_type(
        uuid="string",
        display="string",
        gender="string",
        birthdate="timestamp",
        dead="boolean",
        age="int",
        deathDate="timestamp",
        causeOfDeath="string",
        birthdateEstimated="boolean",
        attributes=T.ArrayType(
            row_type(
                display="string",
                value="string",
                uuid="string",
                voided="boolean",
                attributeType=row_type(display="string", uuid="string"),
            )
        ),
    ),
    identifiers=T.ArrayType(
        row_type(identifier="string", preferred="boolean", location=NAME_UUID, identifierType=NAME_UUID)
    ),
    preferredAddress=row_type(
        cityVillage="string",
        longitude="string",
        latitude="string",
        country="string",
        countyDistrict="string",
        **{f"address{i}": "string" for i in range(1, 7)},
        preferred="string",
    ),
)

# -- change rows ------------------------------------------------------------------------------

ENCOUNTER_CHANGE = row_type(
    encounter_id="int",
    encounter_type="int",
    patient_id="int",
    form_id="int",
    location_id="int",
    visit_id="int",
    creator="int",
    changed_by="int",
    voided="int",
    voided_by="int",
    encounter_datetime="string",
    date_created="string",
    date_changed="string",
    date_voided="string",
    void_reason="string",
    uuid="string",
)

VITALS_CHANGE = row_type(
    person_id="int",
    uuid="string",
    encounter_id="int",
    encounter_datetime="bigint",
    location_id="int",
    weight="string",
    height="string",
    temp="string",
    oxygen_sat="string",
    systolic_bp="string",
    diastolic_bp="string",
    pulse="string",
)

PROGRAM_ENROLLMENT_CHANGE = row_type(
    patient_program_id="int",
    patient_id="int",
    program_id="int",
    date_enrolled="bigint",
    date_completed="bigint",
    uuid="string",
    location_id="int",
)

# Keys of the rows whose documents are looked up again and not taken from the change row.
ORDER_CHANGE = row_type(order_id="int", patient_id="int", orderer="int", encounter_id="int", location_id="int")
LAB_CHANGE = row_type(person_id="int", encounter_id="int")
PERSON_CHANGE = row_type(person_id="int")

# Date columns of the HIV summary that arrive as epoch numbers.
HIV_DATE_COLUMNS = """
    encounter_datetime enrollment_date hiv_start_date death_date transfer_in_date transfer_out_date
    prev_rtc_date rtc_date arv_first_regimen_start_date arv_start_date prev_arv_start_date
    prev_arv_end_date tb_screening_datetime ipt_start_date ipt_stop_date ipt_completion_date
    tb_tx_start_date tb_tx_end_date pcp_prophylaxis_start_date condoms_provided_date
    modern_contraceptive_method_start_date cd4_resulted_date cd4_1_date cd4_2_date
    cd4_percent_1_date cd4_percent_2_date vl_resulted_date vl_1_date vl_2_date vl_order_date
    cd4_order_date hiv_dna_pcr_order_date hiv_rapid_test_resulted_date prev_encounter_datetime_hiv
    next_encounter_datetime_hiv prev_clinical_datetime_hiv next_clinical_datetime_hiv
    prev_clinical_rtc_date_hiv next_clinical_rtc_date_hiv outreach_date_bncd
    outreach_death_date_bncd transfer_date_bncd
""".split()

# The other columns of the HIV summary change row, by type.
HIV_TEXT_COLUMNS = """
    date_created uuid location_uuid patient_care_status arv_first_regimen prev_arv_meds cur_arv_meds
    cur_arv_meds_strict prev_arv_adherence cur_arv_adherence tb_screening_result contraceptive_method
    discordant_status outreach_patient_care_status_bncd transfer_transfer_out_bncd
""".split()
HIV_INT_COLUMNS = """
    person_id visit_id encounter_id encounter_type is_clinical_encounter location_id visit_num
    enrollment_location_id scheduled_visit transfer_in transfer_in_location_id transfer_out
    transfer_out_location_id out_of_care arv_first_regimen_location_id arv_start_location_id
    prev_arv_line cur_arv_line cur_arv_line_strict cur_arv_line_reported hiv_status_disclosed edd
    tb_screen on_ipt on_tb_tx cur_who_stage cd4_resulted vl_resulted hiv_dna_pcr_resulted
    prev_encounter_type_hiv next_encounter_type_hiv prev_clinical_location_id
    next_clinical_location_id
""".split()
HIV_NUMBER_COLUMNS = "cd4_1 cd4_2 cd4_percent_1 cd4_percent_2 vl_1 vl_2".split()

# Date columns are read as bigint, since some of them arrive in milliseconds.
HIV_SUMMARY_CHANGE = row_type(
    **dict.fromkeys(HIV_TEXT_COLUMNS, "string"),
    **dict.fromkeys(HIV_INT_COLUMNS, "int"),
    **dict.fromkeys(HIV_DATE_COLUMNS, "bigint"),
    **dict.fromkeys(HIV_NUMBER_COLUMNS, "double"),
)


def change_envelope(after: T.StructType) -> T.StructType:
    """Envelope of a change event; ``after`` is NULL for a delete."""
    return row_type(schema=row_type(name="string"), payload=row_type(after=after, op="string", ts_ms="bigint"))
